"""Prefix trie of conversations from padded matrices of turn ids.

Conversations are range-sorted by their turns' ids, so that the members of every node stand together. A task takes
its shard in blocks: a block is a matrix with a row for each conversation and a column for each turn, shorter rows padded;
it is lexsorted, changes against the row above are OR-accumulated along the columns, so that a mask per depth marks
where nodes start, and ``reduceat`` adds up each depth from the deepest on. Nodes that may go on in a neighbouring
block or shard lie on the path of the first or the last row; what is known of them becomes rows of weights along these two
paths, which enter the next block, and at the end of the shard the next round: there the paths of
neighbouring shards are the rows, and the same step completes the nodes between them, until one shard is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import written

#: Bytes of a turn's id.
ID = 16
#: Cells of a block's matrix; a conversation longer than that is a block of its own.
CELLS = 1 << 18
#: Neighbouring shards whose paths are merged by one task of a round; two at least.
FAN = 256
_NONE = np.iinfo(np.int64).max
_EMPTY = hashlib.sha256(b"").hexdigest()
#: What adds up along a path: members, smallest member, completed children, their leaves and what they save.
_WEIGHTS = ("convs", "least", "children", "leaves", "saved")


# ---- rebuilt conversations


def turn_id(role: Column, text: Column) -> Column:
    """Hexadecimal id of a turn: a 128-bit hash of role and text, nulls as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id`` (long), ``turns`` (array of ``id``, ``bytes``) in the order of ``turn``, null first, ties by id.

    Rows without a conversation id belong to none and are left out. Role and text count as empty when null. A
    conversation is one value of about 40 bytes a turn.
    """
    one = F.struct(F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"))
    some = turns.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), one.alias("one"))
    ordered = F.transform(F.sort_array(F.collect_list("one")), lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes")))
    return some.groupBy("conv_id").agg(ordered.alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation ``c`` begins with the first ``h`` turns of ``c - c % 5`` and goes on with its own after the first ``h``; ``h = crc32(c) % 9``."""
    base = conversations.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    own = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).withColumn("h", h).join(base, "base", "left")
    tail = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    none = F.slice("turns", 1, 0)
    return own.select("conv_id", F.concat(F.coalesce(F.slice("head", 1, F.col("h")), none), F.coalesce(tail, none)).alias("turns"))


# ---- one block


@dataclass
class Block:
    """Rows in the order of their paths, each with weights for depth 0 to its length."""

    paths: list[bytes]
    sizes: list[np.ndarray]
    weights: dict[str, list[np.ndarray]]
    #: Conversation that ends with the row, for rows that are one.
    ends: np.ndarray | None = None
    #: The first row is the open path of the block before.
    carried: bool = False


@dataclass
class Path:
    """An open path: what is known of the nodes along it."""

    path: bytes
    sizes: np.ndarray
    weights: dict[str, np.ndarray]

    @staticmethod
    def empty(path: bytes, sizes: np.ndarray) -> Path:
        zero = {n: np.zeros(len(sizes) + 1, np.int64) for n in _WEIGHTS}
        zero["least"][:] = _NONE
        return Path(path, sizes, zero)

    def add(self, depth: int, values: dict[str, int]) -> None:
        for name in _WEIGHTS:
            self.weights[name][depth] = min(self.weights[name][depth], values[name]) if name == "least" else self.weights[name][depth] + values[name]


@dataclass
class Keys:
    """Keys of the nodes along a path: hashes of its prefixes, each computed once."""

    path: bytes
    found: list[bytes] = field(default_factory=list)

    def __getitem__(self, depth: int) -> bytes:
        if not self.found:
            state = hashlib.blake2b(digest_size=16)
            self.found.append(state.digest())
            for d in range(len(self.path) // ID):
                state.update(self.path[d * ID : (d + 1) * ID])
                self.found.append(state.digest())
        return self.found[depth]


def common_turns(one: bytes, other: bytes) -> int:
    """Turns that two paths begin with in common."""
    n = min(len(one), len(other)) // ID
    if not n:
        return 0
    x, y = (np.frombuffer(p, np.uint8, n * ID).reshape(n, ID) for p in (one, other))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def turn_matrix(paths: list[bytes], lengths: np.ndarray, width: int) -> np.ndarray:
    """Rows of turn numbers from 1 that sort as the turns' ids do, padded with 0."""
    matrix = np.zeros((len(paths), width), np.int32)
    if not width:
        return matrix
    # As big-endian pairs of integers, ids sort as bytes do.
    pairs = np.frombuffer(b"".join(paths), ">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (pairs[order][1:] != pairs[order][:-1]).any(axis=1)
    numbers = np.empty(len(order), np.int32)
    numbers[order] = np.cumsum(new)
    matrix[np.arange(width) < lengths[:, None]] = numbers
    return matrix


def _padded(rows: list[np.ndarray], width: int, fill: int = 0) -> np.ndarray:
    out = np.full((len(rows), width), fill, np.int64)
    lengths = np.array([len(r) for r in rows])
    out[np.arange(width) < lengths[:, None]] = np.concatenate(rows) if len(rows) else []
    return out


def _ids_text(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def reduce_block(block: Block, first: Path, final: bool) -> tuple[list[tuple], list[tuple], Path]:
    """Completed nodes, pieces of ends of open ones, and the path of the last row.

    ``first`` is the path of the shard's first row: what is known of its nodes, which may go on to the left, is added to
    it. ``final`` says that nothing follows and nothing went before.
    """
    lengths = np.array([len(p) // ID for p in block.paths], np.int64)
    width = int(lengths.max(initial=0))
    matrix = turn_matrix(block.paths, lengths, width)
    members = block.ends if block.ends is not None else np.arange(len(lengths))
    least_first = members if not block.carried else np.concatenate([[np.iinfo(np.int64).min], members[1:]])
    order = np.lexsort((least_first, *(matrix[:, d] for d in range(width - 1, -1, -1))))
    matrix, lengths = matrix[order], lengths[order]
    ends = block.ends[order] if block.ends is not None else None
    sizes = _padded([block.sizes[i] for i in order], width)
    weights = {n: _padded([block.weights[n][i] for i in order], width + 1, _NONE if n == "least" else 0) for n in _WEIGHTS}
    rows = len(lengths)
    changed = np.ones((rows, width), bool)
    changed[1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    head, tail = block.paths[order[0]], block.paths[order[-1]]
    left = -1 if final else common_turns(head, first.path)
    last = Path.empty(tail, block.sizes[order[-1]])
    head_keys, tail_keys = Keys(head), Keys(tail)
    row_keys: dict[int, Keys] = {0: head_keys}
    found: dict[int, tuple] = {}
    for depth in range(width, -1, -1):
        starts = np.flatnonzero(changed[:, depth - 1]) if depth else np.zeros(1, np.int64)
        sums = {n: (np.minimum if n == "least" else np.add).reduceat(weights[n][:, depth], starts) for n in _WEIGHTS}
        real = lengths[starts] >= depth
        complete = real.copy()
        values = lambda at: {n: int(sums[n][at]) for n in _WEIGHTS}  # noqa: B023, E731
        if not final:
            if real[0] and depth <= left:
                first.add(depth, values(0))
                complete[0] = False
            if real[-1]:
                if complete[-1]:
                    last.add(depth, values(-1))
                complete[-1] = False
        at = starts[complete]
        leaves = sums["leaves"][complete] + (sums["children"][complete] == 0)
        own_size = sizes[at, depth - 1] if depth else np.zeros(len(at), np.int64)
        saved = sums["saved"][complete] + (sums["convs"][complete] - 1) * own_size
        if depth:
            np.add.at(weights["children"], (at, depth - 1), 1)
            np.add.at(weights["leaves"], (at, depth - 1), leaves)
            np.add.at(weights["saved"], (at, depth - 1), saved)
        found[depth] = starts, complete, sums, leaves, saved
    # Rows with equal paths end at the same node.
    end_hash: dict[tuple[int, int], str] = {}
    pieces: list[tuple] = []
    if ends is not None:
        same = np.flatnonzero(changed[:, -1]) if width else np.zeros(1, np.int64)
        for start, stop in zip(same.tolist(), [*same[1:].tolist(), rows], strict=True):
            depth, skip = int(lengths[start]), 1 if block.carried and start == 0 else 0
            if start + skip == stop:
                continue
            starts, complete = found[depth][:2]
            group = int(np.searchsorted(starts, start, "right")) - 1
            text = _ids_text(ends[start + skip : stop])
            if complete[group] and not (block.carried and starts[group] == 0):
                end_hash[depth, int(starts[group])] = hashlib.sha256(text).hexdigest()
            else:
                pieces.append(((head_keys if starts[group] == 0 else tail_keys)[depth], int(ends[start + skip]), text))
    nodes: list[tuple] = []
    for depth in range(width + 1):
        starts, complete, sums, leaves, saved = found[depth]
        if depth:
            above, above_complete, above_sums = found[depth - 1][:3]
            parent = np.searchsorted(above, starts, "right") - 1
        kept = np.flatnonzero(complete)
        for n, g in enumerate(kept.tolist()):
            start = int(starts[g])
            # A node that was open before may have members and children elsewhere, which look for it by its key.
            # In the rounds that holds for every node.
            key = None
            if block.ends is None or (block.carried and start == 0):
                key = row_keys.setdefault(start, Keys(block.paths[order[start]]))[depth]
            parent_id = parent_key = None
            if depth:
                p = int(parent[g])
                if above_complete[p]:
                    parent_id = int(above_sums["least"][p])
                else:
                    parent_key = (head_keys if above[p] == 0 else tail_keys)[depth - 1]
            ends_of = None if key is not None else end_hash.get((depth, start), _EMPTY)
            nodes.append((int(sums["least"][g]), depth, parent_id, parent_key, key, int(sums["convs"][g]), int(sums["children"][g]), int(leaves[n]), int(saved[n]), ends_of))
    return nodes, pieces, last


# ---- shards

_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()), ("key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_PIECE = [("piece_key", pa.binary()), ("piece_first", pa.int64()), ("piece", pa.binary())]
_PATH = [("place", pa.int64()), ("path", pa.binary()), ("sizes", pa.list_(pa.int64())), *((n, pa.list_(pa.int64())) for n in _WEIGHTS)]
_OUT = pa.schema([*_NODE, *_PIECE, *_PATH])
_DDL = (
    "conv_id long, depth long, parent_conv_id long, parent_key binary, key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "piece_key binary, piece_first long, piece binary, place long, path binary, sizes array<long>, " + ", ".join(f"{n} array<long>" for n in _WEIGHTS)
)


def _table(fields: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of some of the output's columns, null in all others."""
    columns = dict(zip([f[0] for f in fields], zip(*rows, strict=True), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in _OUT], schema=_OUT)


def _paths_out(places: list[int], paths: list[Path]) -> pa.RecordBatch:
    return _table(_PATH, [(at, p.path, p.sizes.tolist(), *(p.weights[n].tolist() for n in _WEIGHTS)) for at, p in zip(places, paths, strict=True)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[np.ndarray], list[int]]]:
    """Conversations in blocks of at most ``CELLS`` cells, padding included."""
    paths, sizes, ids, width = [], [], [], 0
    for batch in batches:
        for conv, path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            wide = max(width, len(path) // ID + 1)
            if paths and wide * (len(paths) + 1) > CELLS:
                yield paths, sizes, ids
                paths, sizes, ids, wide = [], [], [], len(path) // ID + 1
            width = wide
            paths.append(path)
            sizes.append(size.values.to_numpy())
            ids.append(conv)
    if paths:
        yield paths, sizes, ids


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, pieces and open paths of one range of sorted conversations."""
    part, first, last = TaskContext.get().partitionId(), None, None
    for paths, sizes, ids in _blocks(batches):
        weights = {n: [np.full(len(s) + 1, v, np.int64) for s in sizes] for n, v in (("convs", 1), ("children", 0), ("leaves", 0), ("saved", 0))}
        weights["least"] = [np.full(len(s) + 1, i, np.int64) for s, i in zip(sizes, ids, strict=True)]
        if first is None:
            first = Path.empty(paths[0], sizes[0])
        else:
            paths, sizes, ids = [last.path, *paths], [last.sizes, *sizes], [-1, *ids]
            weights = {n: [last.weights[n], *w] for n, w in weights.items()}
        block = Block(paths, sizes, weights, np.array(ids, np.int64), last is not None)
        nodes, pieces, last = reduce_block(block, first, False)
        if nodes:
            yield _table(_NODE, nodes)
        if pieces:
            yield _table(_PIECE, pieces)
    if first is not None:
        yield _paths_out([2 * part, 2 * part + 1], [first, last])


def _merge(final: bool):
    """The step of a round: the open paths of neighbouring shards, sorted by place, become nodes and two open paths."""

    def merged(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        group = held[0][0]
        weights = {n: [r[3 + i] for r in held] for i, n in enumerate(_WEIGHTS)}
        first = Path.empty(held[0][1], held[0][2])
        nodes, _, last = reduce_block(Block([r[1] for r in held], [r[2] for r in held], weights), first, final)
        if nodes:
            yield _table(_NODE, nodes)
        if not final:
            yield _paths_out([2 * group, 2 * group + 1], [first, last])

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            names = ["group", "path", "sizes", *_WEIGHTS]
            columns = [batch.column(n) for n in names]
            for i in range(batch.num_rows):
                group, path = columns[0][i].as_py(), columns[1][i].as_py()
                if held and held[0][0] != group:
                    yield from merged(held)
                    held = []
                held.append((group, path, *(c[i].values.to_numpy() for c in columns[2:])))
        if held:
            yield from merged(held)

    return rounds


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces sorted by key and first id, the hash of each key's joined pieces; one piece is in memory at a time."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for one, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if one != key:
                if key is not None:
                    keys.append(key)
                    hashes.append(state.hexdigest())
                key, state = one, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py())
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends": pa.array(hashes, pa.string())})
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": pa.array([state.hexdigest()], pa.string())})


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node from ``conv_id`` (long, unique, not null) and ``turns`` (array of ``id``, ``bytes``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``. A conversation without turns is a member of the root alone; without conversations there
    is no node. Turns are compared by 128-bit hashes.
    """
    spark = conversations.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    flat = conversations.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    shards = flat.repartitionByRange(partitions, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    out = written(shards.mapInArrow(_shard, _DDL), "trie-shards")
    rounds, left = [out], (out.agg(F.max("place")).first()[0] or 0) + 1
    pieces = out.filter("piece_key is not null").select("piece_key", "piece", "piece_first")
    while True:
        final = left <= 2 * FAN
        paths = rounds[-1].filter("path is not null").select(F.floor(F.col("place") / (2 * FAN)).alias("group"), "place", "path", "sizes", *_WEIGHTS)
        groups = -(-left // (2 * FAN))
        placed = paths.repartition(min(groups, partitions), "group").sortWithinPartitions("group", "place")
        rounds.append(written(placed.mapInArrow(_merge(final), _DDL), f"trie-round-{len(rounds)}"))
        if final:
            break
        left = 2 * groups
    nodes = [r.filter("depth is not null").select(*(f[0] for f in _NODE)) for r in rounds]
    everything = nodes[0]
    for more in nodes[1:]:
        everything = everything.unionByName(more)
    named = everything.filter("key is not null")
    parents = written(named.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found_parent")), "trie-parents")
    sorted_pieces = pieces.repartition(partitions, "piece_key").sortWithinPartitions("piece_key", "piece_first").select("piece_key", "piece")
    ends = written(sorted_pieces.mapInArrow(_ends, "key binary, ends string"), "trie-ends")
    # Nodes with a key are few; those that look for a parent may be many for one parent, the root.
    joined = everything.join(parents, "parent_key", "left").join(ends, "key", "left")
    return joined.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", "ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
