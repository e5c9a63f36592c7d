"""Merkle manifest of a dataset: a postorder append log per tree, and proofs read from it by position.

Leaves are numbered within their tree by a range sort. A builder owns an aligned block of ``ARITY ** TIER``
leaves, streams through them in order and appends every node to its segment of the log when the node's last
child is complete. So a segment is one string of fixed-width digests in postorder, and where the node at a
level and index stands in it follows from the sizes of the subtrees before it (:func:`position`). The roots of
the blocks are the leaves of the next tier, until one is left for each tree; these subroots are the leaves of a
tree of their own, whose root covers the dataset. A proof takes the siblings of a leaf from its segment by
their positions, then those of its block from the tier above, and so on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidegate.llm.common import written

#: Children of a node.
ARITY = 8
#: Levels that one builder completes: its block has ``ARITY ** TIER`` leaves, about 150 KB of digests.
TIER = 4
WIDTH = 32


# ---- positions


def levels_above(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // ARITY), height + 1
    return height


def position(level: int, index: int, leaves: int, height: int) -> int:
    """Place from 0 of a node in the postorder log of a tree with so many leaves and levels.

    Before it and with it are the leaves up to its last one, on every level up to its own all nodes over them, and
    on the levels above those that end before its first leaf.
    """
    end = min((index + 1) * ARITY**level, leaves)
    below = sum(-(-end // ARITY**k) for k in range(1, level + 1))
    above = sum(index // ARITY ** (k - level) for k in range(level + 1, height + 1))
    return end + below + above - 1


def digest_of(children: list[bytes]) -> bytes:
    """Digest of the concatenated children as lower-case hexadecimal text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


class Builder:
    """Appends leaves and completed nodes of one block."""

    def __init__(self, height: int) -> None:
        self.height, self.log = height, bytearray()
        self.open: list[list[bytes]] = [[] for _ in range(height + 1)]

    def append(self, digest: bytes, level: int = 0) -> None:
        self.log += digest
        self.open[level].append(digest)
        if level < self.height and len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        children, self.open[level] = self.open[level], []
        self.append(digest_of(children), level + 1)

    def close(self) -> bytes:
        """The segment, with the last and shorter run of every level completed."""
        for level in range(self.height):
            if self.open[level]:
                self._complete(level)
        return bytes(self.log)


# ---- leaves


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the columns' fields."""
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def tree_key(value: Column) -> Column:
    """A tree's name such that the null tree comes first and others in the order of their bytes."""
    return F.when(value.isNull(), "-").otherwise(F.concat(F.lit("="), value.cast("string")))


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, tree, no = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        numbers = []
        for name in batch.column("tree").to_pylist():
            no = no + 1 if name == tree else 0
            tree = name
            numbers.append(no)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(numbers), pa.int64()), pa.array(numbers, pa.int64())], [*batch.schema.names, "part", "no"]
        )


def numbered(leaves: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``index`` (from 0 within ``tree``, by the order) and ``leaves`` (of the tree).

    Rows equal in the whole order are numbered by where they stand in the input. The ranges are a written table; only one
    row for each range and tree is added up, in a window of as many rows as there are ranges.
    """
    partitions = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = leaves.withColumn("input_place", F.monotonically_increasing_id())
    key = ["tree", *order, "input_place"]
    ranges = placed.repartitionByRange(partitions, *key).sortWithinPartitions(*key).drop("input_place")
    schema = StructType([*ranges.schema.fields, StructField("part", LongType()), StructField("no", LongType())])
    ranges = written(ranges.mapInArrow(_numbering, schema), f"{name}-ranges")
    counts = ranges.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("tree").orderBy("part")
    offsets = counts.select(
        "tree", "part", (F.sum("rows").over(before) - F.col("rows")).alias("offset"), F.sum("rows").over(Window.partitionBy("tree")).alias("leaves")
    )
    joined = ranges.join(written(offsets, f"{name}-offsets"), ["tree", "part"])
    return joined.withColumn("index", F.col("no") + F.col("offset")).drop("part", "no", "offset")


# ---- log


def _height(leaves: int) -> int:
    """Levels of a block in a tree of so many leaves: all of a builder's unless the tree is one block."""
    return min(TIER, levels_above(leaves))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From leaves sorted by tree, block and index, one segment for each block."""
    key, builder = None, None

    def segment() -> pa.RecordBatch:
        tree, block, leaves = key
        return pa.RecordBatch.from_pydict(
            {"tree": [tree], "block": pa.array([block], pa.int64()), "leaves": pa.array([leaves], pa.int64()), "log": pa.array([builder.close()], pa.binary())}
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != key:
                if key is not None:
                    yield segment()
                key, builder = row[:3], Builder(_height(row[2]))
            builder.append(bytes.fromhex(row[4]))
    if key is not None:
        yield segment()


@dataclass
class Forest:
    """Log of each tier, from the leaves up, and ``tree``, ``subroot`` of each tree."""

    tiers: list[DataFrame]
    roots: DataFrame


def _blocks(rows: DataFrame, *columns: str) -> DataFrame:
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "tree", "block").sortWithinPartitions("tree", "block", *columns)


def append_log(leaves: DataFrame, name: str = "merkle") -> Forest:
    """Builds the log from ``tree``, ``index``, ``leaves``, ``digest`` (hexadecimal). A lone leaf is its tree's root."""
    size = ARITY**TIER
    nodes = leaves.select("tree", F.floor(F.col("index") / size).alias("block"), "leaves", "index", "digest")
    largest = leaves.agg(F.max("leaves")).first()[0] or 0
    tiers: list[DataFrame] = []
    while True:
        built = _blocks(nodes, "index").mapInArrow(_segments, "tree string, block long, leaves long, log binary")
        tiers.append(written(built, f"{name}-log-{len(tiers)}"))
        roots = tiers[-1].select("tree", "block", "leaves", F.lower(F.hex(F.substring("log", -WIDTH, WIDTH))).alias("digest"))
        if largest <= size:
            return Forest(tiers, roots.select("tree", F.col("digest").alias("subroot")))
        largest = -(-largest // size)
        nodes = roots.select(
            "tree", F.floor(F.col("block") / size).alias("block"), F.ceil(F.col("leaves") / size).alias("leaves"), F.col("block").alias("index"), "digest"
        )


# ---- proofs

_PATH = "places array<int>, siblings array<string>"


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a block's segment followed by the leaves asked for, each of these with its siblings, level by level."""
    log, leaves, above = b"", 0, ([], [])

    def at(level: int, index: int, size: int, height: int) -> bytes:
        place = position(level, index, size, height) * WIDTH
        return log[place : place + WIDTH]

    for batch in batches:
        columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        asked, digests, places, siblings = [], [], [], []
        for i, block in enumerate(columns["block"]):
            if columns["log"][i] is not None:
                log, leaves, above = columns["log"][i], columns["leaves"][i], (columns["places"][i], columns["siblings"][i])
                continue
            height, size = _height(leaves), min(ARITY**TIER, leaves - block * ARITY**TIER)
            index = columns["index"][i] - block * ARITY**TIER
            own, others = [], []
            digests.append(at(0, index, size, height).hex())
            for level in range(height):
                first = index - index % ARITY
                run = range(first, min(first + ARITY, -(-size // ARITY**level)))
                own.append(index - first)
                others.append(b"".join(at(level, j, size, height) for j in run if j != index).hex())
                index //= ARITY
            asked.append(i)
            places.append(own + above[0])
            siblings.append(others + above[1])
        kept = [c.take(pa.array(asked, pa.int64())) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("block", "leaves", "log", "places", "siblings")]
        names = [n for n in batch.schema.names if n not in ("block", "leaves", "log", "places", "siblings")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(digests, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(siblings, pa.list_(pa.string()))], [*names, "digest", "places", "siblings"]
        )


def _tier_proofs(log: DataFrame, above: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (``tree``, ``index`` and others) with digest and path; ``above`` has the path of each of the tier's blocks."""
    names = [n for n in asked.columns if n not in ("tree", "index")]
    segments = log.join(above, ["tree", "block"])
    leaves = asked.withColumn("block", F.floor(F.col("index") / ARITY**TIER))
    rows = segments.unionByName(leaves, allowMissingColumns=True).select("tree", "block", "leaves", "log", "places", "siblings", "index", *names)
    schema = ", ".join(["tree string", "index long", *(f"`{n}` {asked.schema[n].dataType.simpleString()}" for n in names), "digest string", _PATH])
    # The segment has no index and comes first.
    return _blocks(rows, F.col("index").asc_nulls_first()).mapInArrow(_proofs, schema)


def proofs(forest: Forest, asked: DataFrame, above: DataFrame) -> DataFrame:
    """``asked`` (``tree``, ``index`` and any other columns) with ``digest``, ``places`` and ``siblings`` of each leaf.

    ``places`` has a leaf's place in its run on every level, ``siblings`` the run's other digests concatenated.
    ``above`` has the path from each tree's root on (``tree``, ``places``, ``siblings``).
    """
    paths = above.select("tree", F.lit(0).cast("long").alias("block"), "places", "siblings")
    for tier in range(len(forest.tiers) - 1, 0, -1):
        children = forest.tiers[tier - 1].select("tree", F.col("block").alias("index"))
        paths = _tier_proofs(forest.tiers[tier], paths, children).select("tree", F.col("index").alias("block"), "places", "siblings")
    return _tier_proofs(forest.tiers[0], paths, asked)


def folded(digest: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    width = 2 * WIDTH
    return F.aggregate(
        F.arrays_zip(places.alias("place"), siblings.alias("others")),
        digest,
        lambda node, run: F.sha2(
            F.concat(
                F.substring(run["others"], F.lit(1), run["place"] * width), node, F.substring(run["others"], run["place"] * width + 1, F.lit(ARITY * width))
            ),
            256,
        ),
    )


def manifest(rows: DataFrame, tree: str, order: list[str], digest: str) -> tuple[DataFrame, str | None]:
    """All columns of ``rows`` with ``subroot``, ``places``, ``siblings``; and the root (null without rows).

    ``digest`` names the column with the leaf's hexadecimal digest, ``tree`` the column whose values have a tree each (null
    is a tree), ``order`` the order of the leaves (null first); ties go by digest, and equal rows are leaves of their own. The
    columns ``index``, ``leaves``, ``block``, ``log`` and those added must be free: a clash is a ``ValueError``.
    """
    taken = {"index", "leaves", "block", "log", "part", "no", "offset", "rows", "tree", "input_place", "subroot", "places", "siblings", "digest"} & set(rows.columns)
    if taken:
        raise ValueError(f"columns must be free: {sorted(taken)}")
    leaves = numbered(rows.withColumn("tree", tree_key(F.col(tree))), [*order, digest], "merkle")
    forest = append_log(leaves.select("tree", "index", "leaves", F.col(digest).alias("digest")))
    subroots = numbered(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")), ["name"], "merkle-roots")
    top = append_log(subroots.select("tree", "index", "leaves", "digest"), "merkle-top")
    root = top.roots.first()
    start = top.roots.select("tree", F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("siblings"))
    above = proofs(top, subroots.select("tree", "index", "name", F.col("digest").alias("subroot")), start)
    above = written(above.select(F.col("name").alias("tree"), "subroot", "places", "siblings"), "merkle-above")
    found = proofs(forest, leaves.select("tree", "index", *rows.columns), above).select("tree", *rows.columns, "places", "siblings")
    return found.join(above.select("tree", "subroot"), "tree").drop("tree"), root["subroot"] if root else None
