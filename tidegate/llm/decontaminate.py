"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every substring of the normalised items. Document words are
streamed through it; after each word it knows the longest stretch ending there
that also occurs in an item. Stretches of a window's length or more, and whole
short items, are hits, whose words are removed. Documents are mapped where they
lie; only a benchmark of several blocks shuffles them, once, to their hits.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import add_columns, slices, written

#: A-Z to a-z; everything else below 0x80 but digits and a-z separates words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")
#: Words of the items that one automaton holds; a larger benchmark is handled in several.
BLOCK_WORDS = 400_000
_ADDED = ("n_words", "hit_spans", "hit_items")


def words(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters a-z (upper case folded) and characters beyond ASCII."""
    return [] if text is None else text.translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of the items' word sequences, with the items in which each window occurs."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, item in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item]
            if ids:
                sequences.append((name, ids))
        for _, ids in sequences:
            state = 0
            for word in ids:
                state = self._extend(state, word)
        #: Shortest stretch that can be a hit.
        self.least = min([window, *(len(ids) for _, ids in sequences)])
        self.pairs = {p for _, ids in sequences for p in pairwise(ids)}
        #: The shallowest state on each state's suffix path that is a window long: the state of the window itself.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, ids in sequences:
            state = 0
            for word in ids:
                state = self.next[state][word]
                if len(ids) >= window and self.length[state] >= window:
                    self.windows.setdefault(self.anchor(state), set()).add(name)
            if len(ids) < window:
                while self.length[self.link[state]] >= len(ids):
                    state = self.link[state]
                self.short.setdefault(state, {}).setdefault(len(ids), set()).add(name)

    def anchor(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _split(self, state: int, word: int, target: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        self.link[target] = clone
        return clone

    def _extend(self, state: int, word: int) -> int:
        target = self.next[state].get(word)
        if target is not None:
            return target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[state] + 1)
        self.link.append(0)
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    def _stream(self, ids: list[int], start: int, spans: list[list[int]], found: set[str]) -> None:
        state = matched = 0
        for at, word in enumerate(ids, start + 1):
            while word not in self.next[state]:
                state = self.link[state]
                if state < 0:
                    break
                matched = self.length[state]
            if state < 0:
                state = matched = 0
                continue
            state, matched = self.next[state][word], matched + 1
            hit = 0
            if matched >= self.window:
                hit = matched
                found |= self.windows.get(self.anchor(state), set())
            if self.short:
                above = state
                while above > 0:
                    for length, names in self.short.get(above, {}).items():
                        if length <= matched:
                            hit = max(hit, length)
                            found |= names
                    above = self.link[above]
            if hit:
                if spans and spans[-1][1] >= at - hit:
                    spans[-1] = [min(spans[-1][0], at - hit), at]
                else:
                    spans.append([at - hit, at])

    def match(self, text: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Spans of hit words (start, end) and the items with windows in the text.

        Only stretches of words and word pairs known to the automaton are streamed: elsewhere the
        longest match ends after one word.
        """
        spans: list[list[int]] = []
        found: set[str] = set()
        get, pairs, least = self.vocabulary.get, self.pairs, self.least
        ids = [get(w, -1) for w in text]
        start, end, total = 0, 0, len(ids)
        while start < total:
            if ids[start] < 0:
                start += 1
                continue
            end = start + 1
            while end < total and (ids[end - 1], ids[end]) in pairs:
                end += 1
            if end - start >= least:
                self._stream(ids[start:end], start, spans, found)
            start = end
        return spans, found


def merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


class Machine:
    """A packed automaton, opened where it is used and once in a worker."""

    def __init__(self, packed: bytes):
        self.packed, self.opened = packed, None

    def __reduce__(self) -> tuple:
        return Machine, (self.packed,)

    def match(self, text: list[bytes]) -> tuple[list[list[int]], set[str]]:
        if self.opened is None:
            self.opened = pickle.loads(self.packed)
        return self.opened.match(text)


def built_automata(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> DataFrame | None:
    """``block``, ``machine``: a packed automaton for each block of about ``block_words`` words of the items, built by tasks; none without words.

    A block holds items whole, so an item above ``block_words`` words has a larger one.
    """
    items = benchmark.filter(F.col(text).isNotNull()).select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text"))
    total = items.agg(F.sum(_n_words(F.col("text").cast("string")))).first()[0] or 0
    if not total:
        return None
    blocks = -(-total // block_words)
    # Repeated items say nothing new, and would all be in one block.
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int")).distinct()

    def build(group: pa.Table) -> pa.Table:
        named = sorted(zip(group["item"].to_pylist(), group["text"].to_pylist(), strict=True))
        automaton = SuffixAutomaton([(name, words(body)) for name, body in named], window)
        return pa.table({"block": group["block"][:1], "machine": pa.array([pickle.dumps(automaton, pickle.HIGHEST_PROTOCOL)], pa.binary())})

    return written(dealt.groupBy("block").applyInArrow(build, "block int, machine binary"), "item-automata")


def contaminated_spans(documents: DataFrame, text: str, benchmark: DataFrame, item: str = "item_id", item_text: str = "text", window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``n_words``, ``hit_spans`` (arrays of first and last-but-one word) and ``hit_items`` to the documents.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of a whole item
    that is shorter. Null texts have no words; items without words never match; a null item id reads as "".
    Repeated rows are each answered. An empty benchmark hits nothing. Other columns stay as they are; those that
    have the name of an added one are replaced.

    Tasks build the automata. A benchmark of several blocks takes one pass over the documents for each; the
    driver and the workers hold one automaton at a time, and what a pass hits is written, by digest of the text.
    """
    documents = documents.select(*(n for n in documents.columns if n.lower() not in _ADDED))
    automata = built_automata(benchmark, item, item_text, window, block_words)
    blocks = [] if automata is None else sorted(r["block"] for r in automata.select("block").collect())
    if not blocks:
        nothing = F.array().cast("array<array<int>>").alias("hit_spans"), F.array().cast("array<string>").alias("hit_items")
        return documents.select("*", _n_words(F.col(text)).alias("n_words"), *nothing)
    if len(blocks) == 1:
        shared = _machine(automata, blocks[0])

        def scan(bodies: list) -> dict[str, list]:
            counts, spans, items = [], [], []
            for body in bodies:
                tokens = words(body.encode() if body is not None else None)
                found = shared.value.match(tokens)
                counts.append(len(tokens))
                spans.append(merge(found[0]))
                items.append(sorted(found[1]))
            return {"n_words": counts, "hit_spans": spans, "hit_items": items}

        return add_columns(documents, [text], scan, "n_words long, hit_spans array<array<int>>, hit_items array<string>")
    passes = []
    for block in blocks:
        shared = _machine(automata, block)
        passes.append(written(_hits(documents, text, shared), "item-hits"))
        shared.destroy()
    # One row for each text and block: few, as only hit texts are there.
    hits = reduce(DataFrame.unionByName, passes).groupBy("digest").agg(
        F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items")
    )
    hits = add_columns(hits, ["hit_spans"], lambda spans: {"hit_spans": [merge(s) for s in spans]}, "hit_spans array<array<int>>")
    names = documents.columns
    found = hits.select(F.concat(F.lit("="), "digest").alias("digest"), "hit_spans", "hit_items")
    # The rows travel as one column, so that their names clash with nothing; the digest is marked to be dealt anew.
    rows = documents.select(F.struct(*names).alias("document"), F.concat(F.lit("="), F.sha2(F.col(text).cast("binary"), 256)).alias("digest"))
    joined = rows.join(found, "digest", "left")
    return joined.select(
        *(F.col("document")[n].alias(n) for n in names),
        _n_words(F.col("document")[text]).alias("n_words"),
        F.coalesce("hit_spans", F.array().cast("array<array<int>>")).alias("hit_spans"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"),
    )


def _n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long")


def _machine(automata: DataFrame, block: int) -> Broadcast:
    packed = automata.filter(F.col("block") == block).select("machine").first()[0]
    return automata.sparkSession.sparkContext.broadcast(Machine(bytes(packed)))


def _hits(documents: DataFrame, text: str, shared: Broadcast) -> DataFrame:
    """``digest``, ``hit_spans``, ``hit_items`` of the texts that an automaton hits, once for equal ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows = []
                for body in piece.column(0):
                    encoded = body.as_py() or b""
                    spans, found = shared.value.match(words(encoded))
                    if spans:
                        rows.append((hashlib.sha256(encoded).hexdigest(), merge(spans), sorted(found)))
                columns = zip(*rows, strict=True) if rows else ([], [], [])
                types = pa.string(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["digest", "hit_spans", "hit_items"])

    bodies = documents.filter(F.col(text).isNotNull()).select(F.col(text).cast("binary").alias("text"))
    return bodies.mapInArrow(scan, "digest string, hit_spans array<array<int>>, hit_items array<string>").dropDuplicates(["digest"])


def removed_spans(matched: DataFrame, text: str, most_coverage: float = 0.5) -> DataFrame:
    """The documents without their hit words; one with more than ``most_coverage`` of its words hit is dropped whole.

    What lies between the first and the last character of a span goes with it.
    """
    names = [n for n in matched.columns if n not in _ADDED]
    hit = F.aggregate("hit_spans", F.lit(0), lambda total, s: total + s[1] - s[0])
    kept = matched.filter(hit <= F.col("n_words") * F.lit(most_coverage))

    def cut(bodies: list, hit_spans: list) -> dict[str, list]:
        for i, spans in enumerate(hit_spans):
            if spans:
                body = bodies[i].encode()
                at = [m.span() for m in _WORD.finditer(body.translate(_FOLD))]
                parts, end = [], 0
                for first, last in spans:
                    parts.append(body[end : at[first][0]])
                    end = at[last - 1][1]
                bodies[i] = b"".join([*parts, body[end:]]).decode()
        return {text: bodies}

    return add_columns(kept.select(*names, "hit_spans"), [text, "hit_spans"], cut, f"`{text}` string").select(*names)


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
