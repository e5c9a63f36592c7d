"""Quality rules: a linear-chain conditional random field labels the lines of a text.

Every line is content or boilerplate. The field is trained on a bounded sample
of labelled documents: the lines of a bad one are boilerplate, those of a good one content but for lines that
recur in other documents, so that its sequences move between the labels. Viterbi decoding
labels the lines of all documents, and the share of words in content lines
decides whether a document stays. Counts that fixed rules ask for come along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import add_columns

#: Labelled documents of each class that train the field, chosen by hash.
SAMPLE_DOCUMENTS = 300
#: Runs of lines taken from each of them, chosen by hash from anywhere in the text, and lines in a run.
SAMPLE_RUNS, RUN_LINES = 8, 128
#: Other documents in which a line must recur to be boilerplate. Documents that share half of their lines are copies and do not count.
RECURS = 16
#: Share of words in content lines from which on a document stays.
LEAST_CONTENT = 0.5
#: Fixed by the rule set: fewest words, window of repeated words, most percent of words in repeated windows, symbols.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
FEATURES = 12


def words(text: str) -> list[str]:
    """Runs of characters that are no ASCII white space."""
    return [w for w in _SPACE.split(text) if w]


def line_features(line: str, seen: bool) -> list[float]:
    tokens = words(line)
    n = len(tokens)
    if not n:
        return [1.0, 1.0] + [0.0] * (FEATURES - 2)
    chars = sum(map(len, tokens))
    ends = [t[-1] for t in tokens]
    return [
        1.0,
        0.0,
        min(1.0, np.log1p(n) / 6),
        min(1.0, chars / n / 20),
        min(1.0, 4 * len(_SYMBOLS.findall(line)) / chars),
        sum(map(str.isupper, tokens)) / n,
        sum(c in "#*$%&|<>!" for c in ends) / n,
        len(set(tokens)) / n,
        sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / n,
        min(1.0, 4 * sum(map(str.isdigit, line)) / chars),
        float(ends[-1] in ".!?:;"),
        float(seen),
    ]


def document_features(text: str) -> np.ndarray:
    seen: set[str] = set()
    out = []
    for line in text.split("\n"):
        out.append(line_features(line, line in seen))
        seen.add(line)
    return np.array(out)


def repeated_words(tokens: list[str], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text; window ids come from doubling, without hashing."""
    size, codes = 1, np.unique(np.array(tokens, dtype=object), return_inverse=True)[1].astype(np.int64) if len(tokens) >= window else None
    if codes is None:
        return 0
    while size < window:
        step = min(size, window - size)
        pair = codes[: len(codes) - step] * np.int64(len(codes) + 1) + codes[step:]
        codes, size = np.unique(pair, return_inverse=True)[1].astype(np.int64), size + step
    again = np.bincount(codes)[codes] > 1
    change = np.zeros(len(tokens) + 1, np.int64)
    change[: len(again)] += again
    change[window : window + len(again)] -= again
    return int((np.cumsum(change)[:-1] > 0).sum())


class LineField:
    """Linear-chain field over two labels, 1 for content: weights of features, of transitions and of the first label."""

    def __init__(self) -> None:
        self.weights = np.zeros((FEATURES, 2))
        self.moves = np.zeros((2, 2))
        self.first = np.zeros(2)

    def fit(self, documents: list[np.ndarray], labels: list[np.ndarray], classes: list[tuple[int, float]], rounds: int = 80, rate: float = 0.5, decay: float = 1e-4) -> LineField:
        """Gradient ascent on the log likelihood; the runs of lines go in step, padded to the longest.

        ``labels`` are those of the lines, ``classes`` the class of each run's document and the run's share of it.
        """
        if not documents:
            return self
        longest = max(map(len, documents))
        x = np.zeros((len(documents), longest, FEATURES))
        for i, d in enumerate(documents):
            x[i, : len(d)] = d
        y = np.zeros((len(documents), longest), np.int64)
        for i, marks in enumerate(labels):
            y[i, : len(marks)] = marks
        kind, part = np.array([c for c, _ in classes]), np.array([p for _, p in classes])
        lengths = np.array([len(d) for d in documents])
        alive = np.arange(longest)[None, :] < lengths[:, None]
        # A class or a long document weighs no more than another.
        share = part / lengths * np.where(kind == 1, 0.5 / max(1e-9, part[kind == 1].sum()), 0.5 / max(1e-9, part[kind == 0].sum()))
        truth = np.eye(2)[y] * alive[:, :, None]
        for _ in range(rounds):
            emit = x @ self.weights
            ahead, back = np.zeros_like(emit), np.zeros_like(emit)
            ahead[:, 0] = emit[:, 0] + self.first
            for t in range(1, longest):
                step = np.logaddexp(ahead[:, t - 1, :1] + self.moves[0], ahead[:, t - 1, 1:] + self.moves[1]) + emit[:, t]
                ahead[:, t] = np.where(alive[:, t, None], step, ahead[:, t - 1])
            for t in range(longest - 2, -1, -1):
                after = back[:, t + 1] + emit[:, t + 1]
                step = np.logaddexp(self.moves[:, 0] + after[:, :1], self.moves[:, 1] + after[:, 1:])
                back[:, t] = np.where(alive[:, t + 1, None], step, 0)
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            marginal = np.exp(np.clip(ahead + back - total[:, None, None], -50, 0)) * alive[:, :, None]
            wrong = (truth - marginal) * share[:, None, None]
            self.weights += rate * (np.einsum("dtf,dtl->fl", x, wrong) - decay * self.weights) * 10
            self.first += rate * ((truth[:, 0] - marginal[:, 0]) * share[:, None]).sum(0)
            if longest > 1:
                pair = np.exp(np.clip(ahead[:, :-1, :, None] + self.moves + (emit + back)[:, 1:, None, :] - total[:, None, None, None], -50, 0))
                both = alive[:, 1:, None, None] * share[:, None, None, None]
                true_pair = truth[:, :-1, :, None] * truth[:, 1:, None, :]
                self.moves += rate * (((true_pair - pair) * both).sum((0, 1)) - decay * self.moves)
        return self

    def decode(self, features: np.ndarray) -> list[int]:
        """The likeliest labels of a document's lines (Viterbi); ties go to content."""
        emit = (features @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one = emit[0][0] + self.first[0], emit[0][1] + self.first[1]
        origins = []
        for e0, e1 in emit[1:]:
            origins.append((int(one + m10 >= zero + m00), int(one + m11 >= zero + m01)))
            zero, one = max(zero + m00, one + m10) + e0, max(zero + m01, one + m11) + e1
        label = int(one >= zero)
        labels = [label]
        for origin in reversed(origins):
            label = origin[label]
            labels.append(label)
        return labels[::-1]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and line hashes of some runs of lines of each text."""
    for batch in batches:
        out = []
        for key, label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            lines, seen = text.split("\n"), set()
            again = [line in seen or seen.add(line) is not None for line in lines]
            starts = range(0, len(lines), RUN_LINES)
            chosen = sorted(sorted(starts, key=lambda s, key=key: xxhash.xxh3_64_intdigest(f"{key} {s}"))[:SAMPLE_RUNS])
            for start in chosen:
                part = range(start, min(start + RUN_LINES, len(lines)))
                features = np.array([line_features(lines[i], again[i]) for i in part], np.float32)
                hashes = np.array([xxhash.xxh3_64_intdigest(lines[i].encode()) if lines[i].strip() else 0 for i in part], np.uint64)
                out.append((key, label, start, features.tobytes(), hashes.tobytes()))
        if out:
            keys, labels, starts, features, hashes = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(labels, pa.int32()), pa.array(starts, pa.int64()), pa.array(features, pa.binary()), pa.array(hashes, pa.binary())], ["key", "label", "start", "features", "hashes"])


def recurring(documents: list[set[int]]) -> list[set[int]]:
    """Of each document's lines (hashes) those that ``RECURS`` others have which are no copies of it."""
    where: dict[int, list[int]] = {}
    for i, lines in enumerate(documents):
        for line in lines:
            where.setdefault(line, []).append(i)
    out = []
    for i, lines in enumerate(documents):
        shared = Counter(j for line in lines for j in where[line] if j != i)
        copies = {j for j, n in shared.items() if 2 * n >= min(len(lines), len(documents[j])) and n > 1}
        out.append({line for line in lines if sum(j != i and j not in copies for j in where[line]) >= RECURS})
    return out


def train(documents: DataFrame, doc_id: str, text: str, labels: DataFrame, label: str, most: int = SAMPLE_DOCUMENTS) -> LineField:
    """Fits the field on at most ``most`` labelled documents of each class, those with the smallest hash of their id.

    Of each, at most ``SAMPLE_RUNS`` runs of ``RUN_LINES`` lines are taken; tasks turn them into features, and the driver gets
    those alone, 35 MB at most. ``labels`` has ``doc_id`` and ``label`` (1 good, 0 bad; anything else and null texts are left out).
    Without rows of both classes the field stays neutral and calls every line content.
    """
    some = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("labelled"), F.col(label).alias("label"), F.xxhash64(doc_id).alias("hash"))
    picked = [some.filter(F.col("label") == k).orderBy("hash", "labelled").limit(most) for k in (0, 1)]
    rows = picked[0].unionByName(picked[1]).join(documents.select(F.col(doc_id).alias("at"), F.col(text).alias("body")), F.col("labelled") == F.col("at"))
    bodies = rows.filter("body is not null").select(F.xxhash64("hash", "body").alias("key"), F.col("label").cast("int").alias("label"), "body").dropDuplicates(["key", "label"])
    runs = sorted(bodies.mapInArrow(_runs, "key long, label int, start long, features binary, hashes binary").collect(), key=lambda r: (r["key"], r["label"], r["start"]))
    if {r["label"] for r in runs} != {0, 1}:
        return LineField()
    hashes = [np.frombuffer(r["hashes"], np.uint64).tolist() for r in runs]
    keys = sorted({r["key"] for r in runs})
    lines: dict[int, set[int]] = {k: set() for k in keys}
    for r, h in zip(runs, hashes, strict=True):
        lines[r["key"]].update(x for x in h if x)
    common = dict(zip(keys, recurring([lines[k] for k in keys]), strict=True))
    marks = [np.array([r["label"] and x not in common[r["key"]] for x in h], np.int64) for r, h in zip(runs, hashes, strict=True)]
    features = [np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in runs]
    weights = Counter(r["key"] for r in runs)
    return LineField().fit(features, marks, [(r["label"], 1 / weights[r["key"]]) for r in runs])


def judge(documents: DataFrame, text: str, field: LineField, least_content: float = LEAST_CONTENT) -> DataFrame:
    """Adds the counts, ``content_share``, ``base_failed`` and ``kept`` to the documents.

    Counts are of the whole text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``. A null or empty text has no words, fails the base rules and has content share 0.
    Repeated rows are judged alike. Other columns stay; the added names must be free.
    """
    spark: SparkSession = documents.sparkSession
    shared = spark.sparkContext.broadcast(field)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def one(body: str | None) -> tuple:
        body = body or ""
        tokens = words(body)
        n = len(tokens)
        lines = body.split("\n")
        seen: set[str] = set()
        again, features, weight = 0, [], []
        for line in lines:
            known = line in seen
            size = len(words(line)) if len(lines) > 1 else n
            again += known and size > 0
            features.append(line_features(line, known))
            weight.append(size)
            seen.add(line)
        repeated = repeated_words(tokens)
        failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
        marks = shared.value.decode(np.array(features))
        share = sum(w for w, m in zip(weight, marks, strict=True) if m) / n if n else 0.0
        return n, sum(map(len, tokens)), len(_SYMBOLS.findall(body)), again, repeated, share, failed, not failed and share >= least_content

    def scan(bodies: list) -> dict[str, list]:
        return dict(zip((*counts, "content_share", "base_failed", "kept"), zip(*map(one, bodies), strict=True), strict=True))

    return add_columns(documents, [text], scan, ", ".join(f"{c} long" for c in counts) + ", content_share double, base_failed boolean, kept boolean")
