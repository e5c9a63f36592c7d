"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks. Each block has a vector of hashed tag
path, hashed words and a few measures; a bidirectional LSTM in numpy reads the
whole sequence and marks every block as article or not. It is trained here, on
pages composed from a seeded generator of layouts.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.common import add_columns

PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 256, 48, 7, 16
INPUT = PATH_DIM + WORD_DIM + MEASURES
#: Pages that go through the network together are padded to the longest of them: so many of them at most,
#: and so many blocks with the padding. A longer page goes through alone, in pieces of so many blocks.
TOGETHER, CELLS = 64, 16_384

#: Elements that belong to a line of text; all others end the block before them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page and ends at their own end tag only.
RAW_TEXT = frozenset("script style noscript textarea iframe".split())
#: Start tags that end an svg or math left open before them.
LEAVES_FOREIGN = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul article section main nav aside header footer".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>", re.S)
_COMMENT = re.compile(r"<!--.*", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_STOPS, _DIGITS = re.compile(r"[.,;:!?]"), re.compile(r"\d")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, with decoded text and white space turned into single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0

    def close() -> None:
        nonlocal linked
        if not parts:
            return
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(tuple(x for _, names in stack if _ not in INLINE for x in names), text, linked))
        parts.clear()
        linked = 0

    at, size = 0, len(page)
    last = page.rfind(">")
    while at < size:
        # Behind the last ">" nothing but an open comment is markup.
        found = (_TOKEN if at <= last else _COMMENT).search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            parts.append(text)
            linked += len(text) if links else 0
        if not found:
            break
        at = found.end()
        if found.re is _COMMENT or not found[2]:
            continue
        name, ends = found[2].lower(), bool(found[1])
        if name == "br" or (name not in INLINE and (name not in VOID or name == "hr")):
            if name == "br":
                parts.append(" ")
            else:
                close()
        if name in VOID:
            continue
        if ends:
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            # An inline end tag does not reach out of its block.
            if where >= 0 and not (name in INLINE and any(n not in INLINE for n, _ in stack[where + 1 :])):
                del stack[where:]
            links = sum(n == "a" for n, _ in stack)
            continue
        closed = found[3].rstrip().endswith("/")
        if name in RAW_TEXT:
            if not closed:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        foreign = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("svg", "math", "foreignobject")), -1)
        if foreign >= 0 and stack[foreign][0] != "foreignobject" and name in LEAVES_FOREIGN:
            del stack[foreign:]
        elif closed and (foreign >= 0 or name in ("svg", "math", "object", "template")):
            continue
        if name not in INLINE:
            # Elements whose end tag may be left out, and inline ones left open in them.
            closes = {"p": ("p",), "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "body": ("head",)}.get(name, ("p",))
            bound = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "dt": ("dl",), "dd": ("dl",)}.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    del stack[i:]
                    break
                if stack[i][0] in bound or (stack[i][0] not in INLINE and closes == ("p",)):
                    break
        elif name == "a" and links:  # links do not nest
            while stack and stack.pop()[0] != "a":
                pass
        names = [name]
        for key, *values in _NAMED.findall(found[3]):
            value = next((v for v in values if v), "")
            names += [f"{'role' if key.lower() == 'role' else 'name'}:{part.lower()}" for part in _NAME_PART.findall(value)]
        stack.append((name, tuple(names)))
        links = sum(n == "a" for n, _ in stack)
    close()
    return out


@lru_cache(1 << 16)
def _word_bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_DIM


@lru_cache(1 << 12)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    vector = np.zeros(PATH_DIM, np.float32)
    tags = [t for t in path if ":" not in t]
    for token in {*path, *map(">".join, pairwise(tags)), "end " + (tags or [""])[-1]}:
        vector[zlib.crc32(token.encode()) % PATH_DIM] = 1
    return vector


def vectors(sequence: list[Block], start: int = 0, end: int | None = None) -> np.ndarray:
    """Vectors of the blocks of a page, or of those from ``start`` to ``end``."""
    piece = sequence[start:end]
    out = np.zeros((len(piece), INPUT), np.float32)
    for i, b in enumerate(piece):
        words = b.text.lower().split()
        out[i, :PATH_DIM] = _path_vector(b.path)
        hashed = np.bincount(list(map(_word_bucket, words)), minlength=WORD_DIM)
        out[i, PATH_DIM : PATH_DIM + WORD_DIM] = hashed / np.sqrt(len(words)) / 4
        chars = len(b.text)
        out[i, -MEASURES:] = (
            1,
            min(1.0, np.log1p(len(words)) / 6),
            min(1.0, b.linked / chars),
            min(1.0, 10 * len(_STOPS.findall(b.text)) / chars),
            b.text[-1] in ".!?:\"'",
            min(1.0, 4 * len(_DIGITS.findall(b.text)) / chars),
            (start + i) / len(sequence),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """Bidirectional LSTM with a logistic output for every block."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        shape = lambda *s: (draw.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.weights = {f"{d}{n}": shape(*s) for d in "fb" for n, s in (("x", (INPUT, 4 * HIDDEN)), ("h", (HIDDEN, 4 * HIDDEN)))}
        self.weights |= {f"{d}c": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32) for d in "fb"}
        self.weights |= {"o": shape(2 * HIDDEN, 1), "p": np.zeros(1, np.float32)}

    def _run(self, x: np.ndarray, alive: np.ndarray, way: str, state: tuple | None = None, trace: list | None = None) -> tuple[np.ndarray, tuple]:
        """One direction over (pages, blocks, inputs), from a state to a state; padding leaves it as it is. Steps are added to the trace."""
        w, pages = self.weights, len(x)
        h, c = state or (np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32))
        inputs = x @ w[way + "x"] + w[way + "c"]
        out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
        steps = range(x.shape[1]) if way == "f" else range(x.shape[1] - 1, -1, -1)
        for t in steps:
            gates = inputs[:, t] + h @ w[way + "h"]
            s = _sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(gates[:, 3 * HIDDEN :])
            live = alive[:, t, None]
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            if trace is not None:
                trace.append((t, h, c, i, f, o, g, squashed))
            c = np.where(live, new_c, c)
            h = np.where(live, o * squashed, h)
            out[:, t] = h
        return out, (h, c)

    def scores(self, x: np.ndarray, alive: np.ndarray) -> np.ndarray:
        hidden = np.concatenate([self._run(x, alive, "f")[0], self._run(x, alive, "b")[0]], axis=2)
        return (hidden @ self.weights["o"])[:, :, 0] + self.weights["p"]

    def page_scores(self, sequence: list[Block]) -> np.ndarray:
        """Scores of the blocks of one page of any length: pieces hand their state on, so only one of them is in memory."""
        out = np.full(len(sequence), self.weights["p"][0], np.float32)
        starts = range(0, len(sequence), CELLS)
        for k, way in enumerate("fb"):
            state = None
            for start in starts if way == "f" else reversed(starts):
                x = vectors(sequence, start, start + CELLS)[None]
                hidden, state = self._run(x, np.ones(x.shape[:2], bool), way, state)
                out[start : start + CELLS] += hidden[0] @ self.weights["o"][k * HIDDEN : (k + 1) * HIDDEN, 0]
        return out

    def _gradients(self, x: np.ndarray, alive: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        traces: dict[str, list] = {"f": [], "b": []}
        hidden = np.concatenate([self._run(x, alive, d, trace=traces[d])[0] for d in "fb"], axis=2)
        delta = (_sigmoid((hidden @ w["o"])[:, :, 0] + w["p"]) - y) * alive / max(1, alive.sum())
        grad = {"o": np.einsum("nth,nt->h", hidden, delta)[:, None], "p": delta.sum()[None]}
        back = delta[:, :, None] * w["o"][:, 0]
        for k, d in enumerate("fb"):
            d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            grad[d + "h"] = np.zeros_like(w[d + "h"])
            for t, h, c, i, f, o, g, squashed in reversed(traces[d]):
                live = alive[:, t, None]
                dh = dh + back[:, t, k * HIDDEN : (k + 1) * HIDDEN]
                new_dc = dc + dh * o * (1 - squashed**2)
                step = np.concatenate([new_dc * g * i * (1 - i), new_dc * c * f * (1 - f), dh * squashed * o * (1 - o), new_dc * i * (1 - g**2)], axis=1) * live
                d_gates[:, t] = step
                grad[d + "h"] += h.T @ step
                dh = np.where(live, step @ w[d + "h"].T, dh)
                dc = np.where(live, new_dc * f, dc)
            grad[d + "x"] = np.einsum("nti,ntg->ig", x, d_gates, optimize=True)
            grad[d + "c"] = d_gates.sum((0, 1))
        return grad

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 14, batch: int = 24, rate: float = 0.015, seed: int = 5) -> Labeller:
        """Adam on the cross entropy of blocks."""
        order = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for turn in range(rounds):
            pace = rate * (1 - turn / rounds)
            shuffled = order.permutation(len(pages))
            for at in range(0, len(pages), batch):
                chosen = shuffled[at : at + batch]
                x, alive = padded([pages[i] for i in chosen])
                y = np.zeros(alive.shape, np.float32)
                for row, i in enumerate(chosen):
                    y[row, : len(labels[i])] = labels[i]
                step += 1
                for k, g in self._gradients(x, alive, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def extract(self, pages: list[str]) -> list[str]:
        """Main text of each page; pages of like length run together."""
        sequences = [blocks(p) for p in pages]
        texts = [""] * len(pages)
        for some in grouped([len(s) for s in sequences]):
            if len(sequences[some[0]]) > CELLS:
                scores = [self.page_scores(sequences[some[0]])]
            else:
                scores = self.scores(*padded([vectors(sequences[i]) for i in some]))
            for i, marks in zip(some, scores, strict=True):
                texts[i] = " ".join(b.text for b, m in zip(sequences[i], marks[: len(sequences[i])] > 0, strict=True) if m)
        return texts


def grouped(lengths: list[int]) -> list[list[int]]:
    """Numbers of the pages with blocks, those of like length together: ``TOGETHER`` pages and ``CELLS`` padded blocks at most, or one page."""
    groups: list[list[int]] = []
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lengths.__getitem__):
        if groups and len(groups[-1]) < TOGETHER and (len(groups[-1]) + 1) * lengths[i] <= CELLS:
            groups[-1].append(i)
        else:
            groups.append([i])
    return groups


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, alive = np.zeros((len(pages), longest, INPUT), np.float32), np.zeros((len(pages), longest), bool)
    for i, p in enumerate(pages):
        x[i, : len(p)], alive[i, : len(p)] = p, True
    return x, alive


# ---- training pages

_YES, _NO = "\ue000", "\ue001"
_SYLLABLES = "the an er on ti re or ch en de la que ung ich tion ción ó é ä ou st es ar le ment in au be".split()


class Layouts:
    """Composes pages whose blocks carry their label as a first private-use character."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        d = self.draw
        n = d.randint(least, most)
        noise = d.random() < 0.15
        out = ["".join(d.choices(_SYLLABLES, k=d.randint(1, 4))) + (d.choice(["###", "$$$", "&amp;&amp;&amp;", "%%%"]) if noise else "") for _ in range(n)]
        for i in range(0, n, d.randint(6, 14)):
            out[i] = out[i].capitalize()
            if i:
                out[i - 1] += d.choice(".,.")
        return " ".join(out)

    def inline(self, text: str) -> str:
        """Now and then some of the words become a link or stressed."""
        tokens = text.split(" ")
        if self.draw.random() < 0.3 and len(tokens) > 4:
            i = self.draw.randrange(1, len(tokens))
            tag = self.draw.choice(['a href="/x"', "b", "em", "strong", "span", "code"])
            tokens[i] = f"<{tag}>{tokens[i]}</{tag.split()[0]}>"
        return " ".join(tokens)

    def named(self, *names: str) -> str:
        d = self.draw
        if d.random() < 0.15:
            return ""
        return f' {d.choice(["class", "class", "id"])}="{d.choice(names)}{d.choice(["", "", "-inner", " clear", "-1"])}"'

    def line(self, tag: str, text: str, label: str) -> str:
        return f"<{tag}>{label}{text}</{tag}>" if self.draw.random() < 0.9 or tag != "p" else f"<{tag}>{label}{text}"

    def links(self, n: int, label: str = _NO) -> str:
        kind = self.draw.random()
        each = [f'<a href="/{i}">{{}}{self.words(1, 3)}</a>' for i in range(n)]
        if kind < 0.6:
            return "<ul>" + "".join(f"<li>{x.format(label)}</li>" for x in each) + "</ul>"
        if kind < 0.8:
            return f"<div>{label}" + " | ".join(x.format("") for x in each) + "</div>"
        return "".join(f"<div>{x.format(label)}</div>" for x in each)

    def article(self) -> str:
        d, out = self.draw, []
        if d.random() < 0.85:
            title = self.line("h1", self.words(3, 10), _YES)
            if d.random() < 0.2:
                title = f"<header>{title}{self.line('p', 'By ' + self.words(1, 3), _NO) if d.random() < 0.6 else ''}</header>"
            out.append(title)
        if d.random() < 0.25:
            out.append(f"<div{self.named('byline', 'meta', 'post-meta', 'author', 'date')}>{_NO}{self.words(1, 6)} {d.randint(1, 28)}.{d.randint(1, 12)}.2021</div>")
        for _ in range(d.choice([1, 2, 3, 5, 8, 12, 20])):
            kind = d.random()
            if kind < 0.72:
                body = self.inline(self.words(*d.choice([(1, 1), (1, 3), (4, 20), (15, 60), (40, 150)])))
                out.append(f"<p>{_YES}<b>{body}<br>" if d.random() < 0.12 else self.line("p", body, _YES))
            elif kind < 0.8:
                out.append(self.line(d.choice(["h2", "h3"]), self.words(1, 8), _YES))
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{_YES}{self.inline(self.words(2, 20))}</li>" for _ in range(d.randint(2, 6))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{self.line('p', self.words(5, 30), _YES)}</blockquote>")
            elif kind < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{_YES}{self.words(1, 3)}</td><td>{_YES}{d.randint(1, 999)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.96:
                out.append(self.advert())
            else:
                out.append(f"<div>{_YES}{self.words(10, 60)}</div>")
        if d.random() < 0.2:
            out.append(f"<div{self.named('share', 'social', 'tags', 'share-buttons')}>{self.links(d.randint(2, 5))}</div>")
        inner = "\n".join(out)
        return d.choice(
            [f"<article>{inner}</article>"] * 5
            + [f"<main>{inner}</main>", f"<main><article{self.named('post', 'entry')}>{inner}</article></main>", f'<div class="{d.choice(["content", "post-body", "article-body", "entry-content", "story", "main-content"])}">{inner}</div>', f'<div id="{d.choice(["content", "main", "article", "post"])}">{inner}</div>', f"<section{self.named('article', 'post')}>{inner}</section>"]
        )

    def advert(self) -> str:
        return f"<{(t := self.draw.choice(['div', 'div', 'aside', 'section']))} class=\"{self.draw.choice(['ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'banner-ad'])}\">{self.line('p', self.words(2, 25), _NO) if self.draw.random() < 0.5 else _NO + self.words(2, 25)}</{t}>"

    def notice(self) -> str:
        d = self.draw
        return f'<div class="{d.choice(["cookie", "cookie-banner", "notice", "consent", "alert", "gdpr", "newsletter", "popup", "modal", "warning"])}">{self.line("p", self.words(5, 40), _NO)}{f"<button>{_NO}{self.words(1, 2)}</button>" if d.random() < 0.6 else ""}</div>'

    def form(self) -> str:
        d = self.draw
        fields = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(d.randint(1, 4)))
        choice = f"<select><option>{_NO}{self.words(1, 2)}<option>{_NO}{self.words(1, 2)}</select>" if d.random() < 0.3 else ""
        return f"<form{self.named('search', 'login', 'subscribe')}><div>{_NO}{fields}</div>{choice}<button>{_NO}{self.words(1, 2)}</button>{self.line('p', self.words(3, 30), _NO) if d.random() < 0.4 else ''}</form>"

    def sidebar(self) -> str:
        d = self.draw
        inner = "".join(
            d.choice([lambda: self.line("h3", self.words(1, 4), _NO) + self.links(d.randint(2, 8)), lambda: self.line("p", self.words(5, 60), _NO), lambda: self.links(d.randint(3, 6))])() for _ in range(d.randint(1, 3))
        )
        return f"<aside{self.named('sidebar', 'related', 'widget')}>{inner}</aside>" if d.random() < 0.5 else f'<div class="{d.choice(["sidebar", "related", "widget", "side", "recommended", "most-read", "trending"])}">{inner}</div>'

    def comments(self) -> str:
        d = self.draw
        each = "".join(
            f"<{(t := d.choice(['div', 'li', 'article', 'p']))}{self.named('comment', 'reply', 'comment-body')}>{_NO if t == 'p' else ''}"
            + (self.words(5, 60) if t == "p" else f"<b>{_NO}{self.words(1, 2)}</b>{self.line('p', self.words(5, 60), _NO)}")
            + f"</{t}>"
            for _ in range(d.randint(1, 6))
        )
        tag = d.choice(["section", "div", "div", "ol"])
        return f'<{tag} {d.choice(["class", "id"])}="{d.choice(["comments", "comment-list", "discussion", "responses", "reader-comments", "disqus"])}">{self.line("h2", self.words(1, 3), _NO) if d.random() < 0.6 else ""}{each}</{tag}>'

    def page(self) -> str:
        d = self.draw
        some = lambda chance, part: part() if d.random() < chance else ""
        menu = lambda: d.choice(["<nav>{}</nav>"] * 3 + ["<div class=\"nav\">{}</div>", "<div id=\"menu\">{}</div>", "<ul class=\"menu\">{}</ul>", "<div class=\"breadcrumb\">{}</div>"]).format(self.links(d.randint(2, 9)))
        header = lambda: f"<header{self.named('header', 'top', 'masthead')}>{self.line(d.choice(['h1', 'div', 'p']), self.words(1, 5), _NO)}{some(0.5, menu)}</header>" if d.random() < 0.6 else f'<div class="{d.choice(["header", "site-header", "topbar"])}">{self.line(d.choice(["h1", "div", "p"]), self.words(1, 6), _NO)}</div>'
        footer = lambda: f"<footer>{_NO}&copy; {self.words(2, 14)}{some(0.3, lambda: self.links(3))}</footer>" if d.random() < 0.7 else f'<div class="{d.choice(["footer", "site-footer", "copyright", "bottom"])}">{self.line("p", "&copy; " + self.words(2, 20), _NO)}{some(0.5, lambda: self.links(4))}</div>'
        before = [some(0.35, header), some(0.8, menu), some(0.2, self.notice), some(0.45, self.advert), some(0.15, self.form), some(0.12, self.sidebar)]
        after = [some(0.3, self.comments), some(0.3, self.sidebar), some(0.25, self.advert), some(0.2, self.form), some(0.15, self.notice), some(0.15, menu)]
        d.shuffle(after)
        body = "\n".join([*before, self.article(), *after, some(0.85, footer)])
        if d.random() < 0.3:
            body = f'<div{self.named("wrapper", "container", "page", "row")}>{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{_NO}{self.words(2, 9)}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"


@lru_cache(2)
def trained(pages: int = 700, seed: int = 11) -> Labeller:
    """A labeller trained on so many composed pages; the same in every run."""
    layouts, xs, ys = Layouts(seed), [], []
    for _ in range(pages):
        sequence = blocks(layouts.page())
        # A block takes the label of its first mark; one without any is not part of the training.
        marked = [(Block(b.path, b.text.replace(_YES, "").replace(_NO, "").strip() or "x", b.linked), float(next(c for c in b.text if c in _YES + _NO) == _YES)) for b in sequence if _YES in b.text or _NO in b.text]
        if marked:
            xs.append(vectors([b for b, _ in marked]))
            ys.append(np.array([y for _, y in marked], np.float32))
    return Labeller().fit(xs, ys)


def extract(pages: DataFrame, html: str, labeller: Labeller | None = None) -> DataFrame:
    """Adds ``text``, the main text of each page's whole html ("" if there is none or html is null).

    Repeated rows get equal texts. Other columns stay; one that is called ``text`` is replaced. A page of very
    many blocks needs memory for its blocks and for one piece of their vectors.
    """
    spark: SparkSession = pages.sparkSession
    shared = spark.sparkContext.broadcast(labeller or trained())

    def scan(bodies: list) -> dict[str, list]:
        return {"text": shared.value.extract([p or "" for p in bodies])}

    return add_columns(pages, [html], scan, "text string")
