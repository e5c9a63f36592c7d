"""Substring dedup with prefix-partitioned suffix trees.

A suffix is followed for ``WINDOW`` words, as a string of ``SYMBOLS`` symbols,
each standing for ``BLOCK`` words. Range partitioning cuts the space of these
strings at prefixes of varying length, so that every group of suffixes fits in
memory, and where one string alone is too frequent the cut goes through its
occurrences. A group, sorted, is its subtree: the common prefix of neighbours
gives the inner nodes, and nodes as deep as the window are the repeats. What
touches a cut is compared across it.

Only suffixes that can repeat are emitted. The smallest hash among the
``GRAM``-word grams of a window is its anchor; equal windows have equal anchors,
so a window whose anchor occurs once in all documents cannot repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import dealt_anew

WINDOW, BLOCK, SYMBOLS, GRAM = 35, 7, 5, 22
#: Words whose ids a worker remembers.
CACHE_WORDS = 200_000
#: Rows that a task hands over at once.
FLUSH_ROWS = 100_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordIds(dict):
    """64-bit ids of words, computed once for each word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Rolling:
    """Hashes of all runs of a given number of words, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 2 * len(self.powers))
            self.powers, self.inverses = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            for series in (self.powers, self.inverses):
                series[0] = 1
                np.cumprod(series, out=series)

    def sums(self, ids: np.ndarray) -> np.ndarray:
        self._grow(len(ids) + 1)
        out = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(ids * self.powers[: len(ids)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, width: int) -> np.ndarray:
        n = len(sums) - width
        h = (sums[width:] - sums[:n]) * self.inverses[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


class Tokens:
    """Words and hashes of texts, with the memory that one worker keeps."""

    def __init__(self) -> None:
        self.ids, self.rolling = WordIds(), Rolling()

    def sums(self, text: bytes | None) -> np.ndarray | None:
        words = text.split() if text else []  # on ASCII white space
        if len(words) < WINDOW:
            return None
        return self.rolling.sums(np.array(list(map(self.ids.__getitem__, words)), np.uint64))

    def anchors(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all grams, the anchor's hash of each window, and where anchors begin."""
        grams = self.rolling.hashes(sums, GRAM)
        spread = WINDOW - GRAM + 1
        of_window = sliding(np.minimum, grams, spread)
        rim = np.zeros(spread - 1, np.uint64)
        # A gram is an anchor if it is as small as the smallest of some window around it.
        return grams, of_window, np.flatnonzero(sliding(np.maximum, np.concatenate([rim, of_window, rim]), spread) == grams)


def sliding(choose: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` values, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values, size = choose(values[:-step], values[step:]), size + step
    return values


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's anchors: hash and first word."""
    tokens = Tokens()
    for batch in batches:
        rows, hashes, starts, pending = [], [], [], 0
        for i, text in enumerate(batch.column(2)):
            sums = tokens.sums(text.as_py())
            if sums is None:
                continue
            grams, _, at = tokens.anchors(sums)
            rows.append(np.full(len(at), i, np.int64))
            hashes.append(grams[at])
            starts.append(at)
            pending += len(at)
            if pending >= FLUSH_ROWS:
                yield _anchor_batch(batch, rows, hashes, starts)
                rows, hashes, starts, pending = [], [], [], 0
        if rows:
            yield _anchor_batch(batch, rows, hashes, starts)


def _anchor_batch(batch: pa.RecordBatch, rows: list, hashes: list, starts: list) -> pa.RecordBatch:
    of = pa.array(np.concatenate(rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(hashes).view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), pa.array(np.concatenate(starts).astype(np.int32))],
        ["anchor", "doc_id", "version", "start"],
    )


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of the windows whose anchor is among the repeated ones (column 3): their symbols and first word."""
    tokens = Tokens()
    for batch in batches:
        rows, symbols, starts, pending = [], [], [], 0
        for i, (text, anchors) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            sums = tokens.sums(text.as_py())
            if sums is None:
                continue
            grams, of_window, _ = tokens.anchors(sums)
            at = np.flatnonzero(np.isin(of_window, grams[anchors.values.to_numpy()]))
            if len(at):
                block = (tokens.rolling.hashes(sums, BLOCK) >> np.uint64(32)).astype(np.uint64)
                rows.append(np.full(len(at), i, np.int64))
                symbols.append(np.stack([block[at + BLOCK * k] for k in range(SYMBOLS)]))
                starts.append(at)
                pending += len(at)
                if pending >= FLUSH_ROWS:
                    yield _suffix_batch(batch, rows, symbols, starts)
                    rows, symbols, starts, pending = [], [], [], 0
        if rows:
            yield _suffix_batch(batch, rows, symbols, starts)


def _suffix_batch(batch: pa.RecordBatch, rows: list, symbols: list, starts: list) -> pa.RecordBatch:
    of, s = pa.array(np.concatenate(rows)), np.concatenate(symbols, axis=1)
    pair = lambda k: pa.array(((s[k] << np.uint64(32)) | s[k + 1]).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pair(0), pair(2), pa.array(s[4].astype(np.uint32).view(np.int32)), batch.column(0).take(of), batch.column(1).take(of), pa.array(np.concatenate(starts).astype(np.int32))],
        ["s01", "s23", "s4", "doc_id", "version", "start"],
    )


def _deep_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves below the window-deep nodes of a sorted group of suffixes (edge false), and what touches the group's ends.

    A first or last suffix without an equal neighbour in the group comes out as an edge with its place, an end
    that lies in a deep node as an edge without one.
    """
    held: pa.RecordBatch | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None and first and held.num_rows < 2:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        elif held is not None:
            yield from _node_batch(held, batch, first)
            first = False
            # The last row is judged with what follows it, the one before it tells what it equals.
            batch = pa.Table.from_batches([held.slice(held.num_rows - 2), batch]).combine_chunks().to_batches()[0]
        held = batch
    if held is not None:
        yield from _node_batch(held, None, first)


def _node_batch(rows: pa.RecordBatch, after: pa.RecordBatch | None, first: bool) -> Iterator[pa.RecordBatch]:
    """Judges the rows between the one carried over and the one that the next call judges."""
    keys = [rows.column(k).to_numpy() for k in range(3)]
    same = np.ones(len(keys[0]) - 1, bool)  # common prefix with the next suffix reaches the window's depth
    for k in keys:
        same &= k[1:] == k[:-1]
    up, down = np.concatenate([[False], same]), np.concatenate([same, [False]])
    deep = up | down
    n = len(deep)
    judged = np.ones(n, bool)
    if not first:
        judged[0] = False  # judged before; it was carried as context
    if after is not None:
        judged[-1] = False  # the next call judges it with its neighbour
    inner = np.flatnonzero(judged & deep)
    edges = []
    if first:
        edges.append(0)
    if after is None:
        edges.append(n - 1)
    edges = [e for e in dict.fromkeys(edges) if judged[e]]
    take = np.concatenate([inner, np.array(edges, np.int64)])
    out = rows.take(pa.array(take))
    placed = np.concatenate([np.ones(len(inner), bool), ~deep[edges]]) if edges else np.ones(len(inner), bool)
    edge = np.concatenate([np.zeros(len(inner), bool), np.ones(len(edges), bool)])
    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(placed), pa.array(edge)], [*out.schema.names, "placed", "edge"])


def repeated_windows(documents: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc_id``, ``version``, ``text``, ``copied``, and the starts of repeated windows of those without copies.

    A text with copies is one suffix source; all of its windows repeat.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.hash(text).alias("version"), F.col(text).cast("binary").alias("text"))
    named = documents.select(F.col(doc_id).alias("doc_id"), F.hash(text).alias("version"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"))
    copies = named.groupBy("digest").agg(F.min(F.struct("doc_id", "version")).alias("source"), F.count("*").alias("n")).filter("n > 1")
    copied = named.join(copies, "digest").select(
        F.col("doc_id").alias("c_doc"), F.col("version").alias("c_version"), (F.col("source") == F.struct("doc_id", "version")).alias("is_source")
    ).distinct()
    known = rows.join(copied, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("version") == F.col("c_version")), "left").select(
        "doc_id", "version", "text", F.col("is_source").isNotNull().alias("copied"), F.coalesce("is_source", F.lit(True)).alias("is_source")
    )
    # No filter on the text: it would be pushed below the shuffle, which would then not be the one that the result uses.
    sources = known.filter("is_source").select("doc_id", "version", "text")
    anchors = sources.mapInArrow(_anchors, "anchor long, doc_id long, version int, start int")
    repeated = anchors.groupBy("anchor").count().filter("count > 1").select(dealt_anew(F.col("anchor")).alias("key"))
    # What is collected for a document is at most its own anchors.
    per_document = anchors.withColumn("key", dealt_anew(F.col("anchor"))).join(repeated, "key").groupBy(F.col("doc_id").alias("a_doc"), F.col("version").alias("a_version")).agg(F.collect_set("start").alias("anchors"))
    candidates = sources.join(per_document, F.col("doc_id").eqNullSafe(F.col("a_doc")) & (F.col("version") == F.col("a_version"))).select("doc_id", "version", "text", "anchors")
    suffixes = candidates.mapInArrow(_suffixes, "s01 long, s23 long, s4 int, doc_id long, version int, start int")
    order = ["s01", "s23", "s4", "doc_id", "version", "start"]
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = suffixes.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    nodes = grouped.mapInArrow(_deep_nodes, "s01 long, s23 long, s4 int, doc_id long, version int, start int, placed boolean, edge boolean")
    inside = nodes.filter("not edge").select("doc_id", "version", "start")
    # At most two edges of a group: few rows, however large the groups are.
    edges = nodes.filter("edge").groupBy("s01", "s23", "s4").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("placed"), F.struct("doc_id", "version", "start"))).alias("at"))
    across = edges.filter("n > 1").select(F.explode("at").alias("at")).select("at.*")
    return known.select("doc_id", "version", "text", "copied"), inside.unionByName(across)


def removed_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if wanted, ``kept`` (kept words joined by spaces) of each row.

    A word goes if it lies in a window of ``WINDOW`` words whose sequence also starts at any other place of any
    document. Null texts have no words; shorter texts keep all of theirs; rows with the same text are copies and
    lose every window. An empty table gives an empty one. ``doc_id`` must be a long and may be null or repeated.
    """
    rows, starts = repeated_windows(documents, doc_id, text)
    marks = starts.groupBy(F.col("doc_id").alias("m_doc"), F.col("version").alias("m_version")).agg(F.collect_set("start").alias("starts"))
    marked = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("version") == F.col("m_version")), "left").select("doc_id", "text", "copied", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for body, copied, at in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                words = (body.as_py() or b"").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if copied and len(words) >= WINDOW:
                    gone[0] = 1
                elif at.is_valid:
                    first = at.values.to_numpy()
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + WINDOW, -1)
                mask = np.cumsum(gone)[:-1] > 0
                kept = b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if not m]) if mask.any() else b" ".join(words)
                out.append((len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    result = marked.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return result if with_text else result.drop("kept")
