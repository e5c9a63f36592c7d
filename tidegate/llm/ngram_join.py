"""Jaccard self-join of word 5-grams by prefix filters under several global token orders.

Two texts of similarity 0.75 or more share a token among the first quarter of
their tokens under any global order. Tokens are ordered by how full their bucket
of a fixed table of counts is, so that passages that many documents share come
last, with a hash to break ties; each order has buckets and hash of its own. The
first order deals out the candidates; those whose prefixes under any other order have
nothing in common go, on rows of hashes, before a text is fetched and the sets are compared.

Near copies are joined to a hub first, which finds most links with one pair per
copy. A hub is chosen by content: of the sets that agree in a smallest hash the one whose tokens
are the most frequent, which among many copies is what they were copied from. Rounds with
other hubs follow while they find links. After that only texts of different components meet, so that a large group
of copies does not become all of its pairs, and no link between components is missed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import dealt_anew, slices, written
from tidegate.llm.components import components
from tidegate.llm.substring_dedup import Rolling

SHINGLE = 5
#: Similarity bound: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Smallest hashes of a set by which hubs are found.
HUB_HASHES = 8
#: Agreeing smallest hashes that make a hub and a copy a pair; only the order of work depends on it, not the result.
HUB_AGREE = 2
ORDERS = 3
#: Rounds of hubs at most, and the share of a round's pairs that must be links for another round; as above.
HUB_ROUNDS, HUB_YIELD = 4, 0.1
#: Buckets of the table of token counts of each order: fixed, whatever the number of tokens. No bucket counts higher than FULL.
BUCKETS, FULL = 1 << 20, (1 << 30) - 1
#: Rows that a task hands over, and tokens that it counts, at once.
FLUSH_ROWS = 100_000
#: Columns of a pair: its documents and, in any order, the components that they are in so far.
PAIR = ["a", "b", "ca", "cb"]
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Longer words are hashed one by one; polynomials over few bytes tell words apart, over thousands they may not.
LONG_WORD = 64
#: Bytes of a text whose words are hashed at once.
PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(6).integers(1, 1 << 63, 256, np.uint64)


class Shingler:
    """Sets of hashed word 5-grams, with the powers that one worker keeps."""

    def __init__(self) -> None:
        self.bytes, self.words = Rolling(), Rolling()

    def word_ids(self, text: bytes) -> np.ndarray:
        """A hash for each word, from prefix sums over the bytes."""
        data = np.frombuffer(text, np.uint8)
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = _SPACE[data]
        starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
        ids = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            # As many words as lie in a piece, one at least.
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
            lo, hi = int(starts[at]), int(ends[stop - 1])
            if stop == at + 1 and hi - lo > LONG_WORD:
                ids[at] = xxhash.xxh3_64_intdigest(text[lo:hi])
                at = stop
                continue
            sums = self.bytes.sums(_BYTES[data[lo:hi]])
            first, length = starts[at:stop] - lo, ends[at:stop] - starts[at:stop]
            h = (sums[first + length] - sums[first]) * self.bytes.inverses[first]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xFF51AFD7ED558CCD)
            ids[at:stop] = h ^ (h >> np.uint64(29))
            for i in np.flatnonzero(length > LONG_WORD).tolist():
                ids[at + i] = xxhash.xxh3_64_intdigest(text[starts[at + i] : ends[at + i]])
            at = stop
        return ids

    def set_of(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes; one for the whole of a shorter text, none for one without words."""
        words = self.word_ids(text.translate(_LOWER)) if text else np.empty(0, np.uint64)
        if not len(words):
            return np.empty(0, np.uint64)
        hashes = self.words.hashes(self.words.sums(words), min(SHINGLE, len(words)))
        hashes.sort()
        new = np.ones(len(hashes), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
        return hashes[new]


def mixed(tokens: np.ndarray, seed: int) -> np.ndarray:
    h = tokens * np.uint64(_ODD[seed])
    h ^= h >> np.uint64(29)
    return h * np.uint64(_ODD[seed] ^ 0x5555555555555554)


def buckets_of(tokens: np.ndarray, order: int) -> np.ndarray:
    return (mixed(tokens, order) >> np.uint64(44)).astype(np.int64)


def first_in_order(tokens: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """The prefix of the tokens under the order: rare buckets first, then by hash; ties by the token itself."""
    full = np.minimum(counts[order][buckets_of(tokens, order)], FULL).astype(np.uint64)
    keys = (full << np.uint64(34)) | (mixed(tokens, order + ORDERS) >> np.uint64(30))
    size = prefix_size(len(tokens))
    if size == len(tokens):
        return tokens[np.argsort(keys, kind="stable")]
    # Ties at the cut must fall the same way for all texts: everything up to the cut's key is sorted, then cut.
    near = np.flatnonzero(keys <= np.partition(keys, size - 1)[size - 1])
    return tokens[near[np.argsort(keys[near], kind="stable")]][:size]


def prefix_size(n: int) -> int:
    return n - -(-n * PERCENT // 100) + 1


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(one) + len(other) - both)


# ---- profiles


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and smallest hashes of each document's set; at the end the task's table of token counts."""
    shingler, counts = Shingler(), np.zeros((ORDERS, BUCKETS), np.int64)
    pending: list[np.ndarray] = []
    held = 0

    def count() -> None:
        everything = np.concatenate(pending)
        for order in range(ORDERS):
            np.add.at(counts[order], buckets_of(everything, order), 1)
        pending.clear()

    for batch in batches:
        out: list[tuple] = []
        for text in batch.column(1):
            tokens = shingler.set_of(text.as_py())
            least = [int((tokens * np.uint64(_ODD[seed])).min().view(np.int64)) for seed in range(HUB_HASHES)] if len(tokens) else None
            digest = [int(v.view(np.int64)) for v in (mixed(tokens, 8).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(tokens, 9)))] if len(tokens) else [0, 0]
            pending.append(tokens)
            held += len(tokens)
            if held >= FLUSH_ROWS:
                count()
                held = 0
            out.append((len(tokens), *digest, least))
        columns = list(zip(*out, strict=True))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.nulls(len(out), pa.binary())], ["doc_id", "n", "d1", "d2", "least", "counts"])
    if pending:
        count()
    if counts.any():
        packed = _packed_counts(counts)
        yield pa.RecordBatch.from_pydict({"doc_id": [None], "n": [None], "d1": [None], "d2": [None], "least": [None], "counts": [packed]}, schema=pa.schema({"doc_id": pa.int64(), "n": pa.int64(), "d1": pa.int64(), "d2": pa.int64(), "least": pa.list_(pa.int64()), "counts": pa.binary()}))


def _packed_counts(counts: np.ndarray) -> bytes:
    return zstandard.compress(np.minimum(counts, FULL).astype(np.int32).tobytes())


class TokenCounts:
    """The tables of token counts, one for each order. Packed until a worker needs them: the driver only hands them on."""

    def __init__(self, packed: bytes | None) -> None:
        self.packed = packed

    @cached_property
    def tables(self) -> np.ndarray:
        flat = np.frombuffer(zstandard.decompress(self.packed), np.int32) if self.packed else np.zeros(ORDERS * BUCKETS, np.int32)
        return flat.reshape(ORDERS, BUCKETS)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((ORDERS, BUCKETS), np.int64)
    for batch in batches:
        for packed in batch.column(0):
            total += TokenCounts(packed.as_py()).tables
    yield pa.RecordBatch.from_pydict({"counts": [_packed_counts(total)]})


def token_counts(profiles: DataFrame) -> TokenCounts:
    """The tables of all tasks added up, in rounds that leave a sixteenth each, so that no task and not the driver gets many."""
    tables = profiles.filter("counts is not null").select("counts")
    left = tables.count()
    while left > 1:
        left = -(-left // 16)
        tables = written(tables.repartition(left).mapInArrow(_added, "counts binary"), "token-counts")
    found = tables.first()
    return TokenCounts(bytes(found["counts"]) if found else None)


# ---- pairs


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([squeeze.compress(t.as_py()) for t in batch.column(1)], pa.binary())], ["doc_id", "packed"])


def of_pairs(rows: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The rows of the documents that are in a pair; the ids are a written table, so that their size is known to the join."""
    ids = pairs.select(F.col("a").alias("in_pair")).unionByName(pairs.select(F.col("b").alias("in_pair"))).distinct()
    return rows.join(written(ids, name), F.col("doc_id") == F.col("in_pair"), "left_semi")


def hub_pairs(each: DataFrame, turn: int) -> DataFrame:
    """Pairs of a set's document and the hub of those that agree with it in a smallest hash, of different components (``ca``, ``cb``).

    ``each`` has a row for each smallest hash. The first round's hub has the most support, that of later ones the
    smallest hash of id and round.
    """
    rank = F.struct(-F.col("support"), "doc_id") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "doc_id"), "doc_id")
    hubs = each.groupBy("seed", "hash").agg(F.min(F.struct(rank.alias("rank"), "doc_id", "n", "component")).alias("hub"), F.min("component").alias("one"), F.max("component").alias("other"))
    key = dealt_anew(F.col("hash")).alias("hash")
    hubs = hubs.filter("one < other").select("seed", key, F.col("hub.doc_id").alias("hub_id"), F.col("hub.n").alias("hub_n"), F.col("hub.component").alias("hub_component"))
    met = each.select("doc_id", "n", "component", "seed", key).join(hubs, ["seed", "hash"]).filter((F.col("hub_component") != F.col("component")) & _sizes_fit(F.col("n"), F.col("hub_n")))
    ends = [F.greatest("component", "hub_component").alias("ca"), F.least("component", "hub_component").alias("cb")]
    pairs = met.groupBy(F.greatest("doc_id", "hub_id").alias("a"), F.least("doc_id", "hub_id").alias("b"), *ends).count()
    return pairs.filter(F.col("count") >= HUB_AGREE).select(*PAIR)


def _sizes_fit(one, other):
    return (one * 100 >= other * PERCENT) & (other * 100 >= one * PERCENT)


def verified(pairs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """The pairs (a written table) whose texts are linked. Only texts in a pair are packed and shuffled."""
    texts = of_pairs(rows.filter("text is not null"), pairs, f"{name}-ids").mapInArrow(_packed, "doc_id long, packed binary")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack = Shingler(), zstandard.ZstdDecompressor()
        held: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def prepared(packed: bytes) -> np.ndarray:
            if packed in held:
                held.move_to_end(packed)
                return held[packed]
            held[packed] = shingler.set_of(unpack.decompress(packed))
            if len(held) > 64:
                held.popitem(last=False)
            return held[packed]

        for batch in batches:
            *pair, ones, others = batch.columns
            keep = pa.array([linked(prepared(one.as_py()), prepared(other.as_py())) for one, other in zip(ones, others, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in pair], PAIR)

    with_one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("one")), "a")
    with_both = with_one.join(texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("other")), "b")
    return written(with_both.select(*PAIR, "one", "other").mapInArrow(judge, ", ".join(f"{c} long" for c in PAIR)), name)


def prefixes(documents: DataFrame, counts) -> DataFrame:
    """``doc_id``, ``n``, ``support``, ``prefix``: size of each set, how frequent its tokens are, and the first quarter of them under the first order."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, tables = Shingler(), counts.value.tables
        for batch in batches:
            for piece in slices(batch):
                rows, sizes, support, found = [], [], [], []
                for i, text in enumerate(piece.column(1)):
                    tokens = shingler.set_of(text.as_py())
                    if len(tokens):
                        rows.append(i)
                        sizes.append(len(tokens))
                        support.append(float(np.log2(tables[0][buckets_of(tokens, 0)] + 1.0).mean()))
                        found.append(first_in_order(tokens, tables, 0).view(np.int64))
                if rows:
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(rows)), pa.array(sizes, pa.int32()), pa.array(support), _lists(found)], ["doc_id", "n", "support", "prefix"])

    return documents.mapInArrow(emit, "doc_id long, n int, support double, prefix array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(a) for a in arrays])]), pa.int32()), pa.array(np.concatenate(arrays)))


def other_prefixes(documents: DataFrame, counts) -> DataFrame:
    """``doc_id`` and the prefix under every order but the first, as 32-bit hashes: what two have in common they have in common here."""
    names = [f"prefix{order}" for order in range(1, ORDERS)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, tables = Shingler(), counts.value.tables
        for batch in batches:
            for piece in slices(batch):
                found = [[] for _ in names]
                for text in piece.column(1):
                    tokens = shingler.set_of(text.as_py())
                    for order, lists in enumerate(found, 1):
                        first = first_in_order(tokens, tables, order) if len(tokens) else tokens
                        lists.append((first >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays([piece.column(0), *map(_lists, found)], ["doc_id", *names])

    return documents.mapInArrow(emit, ", ".join(["doc_id long", *(f"{n} array<int>" for n in names)]))


def prefix_rows(placed: DataFrame) -> DataFrame:
    """``token``, ``component``, ``doc_id``, ``n``, ``place`` of each set's prefix under the first order."""
    each = placed.select("component", "doc_id", "n", F.posexplode("prefix").alias("place", "token"))
    return each.select("token", "component", "doc_id", "n", "place")


def sharing_all(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose prefixes have a token in common under every order but the first, which dealt them out."""
    names = [f"prefix{order}" for order in range(1, ORDERS)]
    if not names:
        return pairs
    side = lambda of: sets.select(F.col("doc_id").alias(of), *(F.col(n).alias(f"{of}_{n}") for n in names))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(reduce(lambda x, y: x & y, [F.arrays_overlap(f"a_{n}", f"b_{n}") for n in names])).select(*PAIR).distinct()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and component, those whose token has two components or is at an end of the batch and may go on outside (open)."""
    for batch in batches:
        token, component = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        ends = np.concatenate([starts[1:], [len(token)]])
        group = np.repeat(np.arange(len(starts)), ends - starts)
        two = (component[starts] != component[ends - 1])[group]
        open_ended = (group == 0) | (group == len(starts) - 1)
        keep = pa.array(np.flatnonzero(two | open_ended))
        out = batch.take(keep)
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(open_ended[keep.to_numpy()])], [*out.schema.names, "open"])


def cross_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of documents of different components that share a prefix token where enough tokens can still follow."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["token", "component", "doc_id"]
    sorted_rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    kept = sorted_rows.mapInArrow(_shared, "token long, component long, doc_id long, n int, place int, open boolean")
    # Tokens at the ends of batches, with what other batches have of them at theirs.
    both = kept.filter("open").groupBy("token").agg(F.min("component").alias("one"), F.max("component").alias("other")).filter("one < other").select(dealt_anew(F.col("token")).alias("key"))
    shared = kept.filter("not open").select("token", "component", "doc_id", "n", "place").unionByName(
        kept.filter("open").withColumn("key", dealt_anew(F.col("token"))).join(both, "key").select("token", "component", "doc_id", "n", "place")
    )
    x, y = shared.alias("x"), shared.alias("y")
    least = F.ceil((F.col("x.n") + F.col("y.n")) * PERCENT / (100 + PERCENT) - F.lit(1e-9))
    can_follow = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    fits = (F.col("x.doc_id") > F.col("y.doc_id")) & (F.col("x.component") != F.col("y.component")) & _sizes_fit(F.col("x.n"), F.col("y.n")) & (can_follow >= least)
    return x.join(y, (F.col("x.token") == F.col("y.token")) & fits).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb")).distinct()


def _placed(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """The rows with their component; a document without links is its own."""
    return rows.join(grouped, F.col("doc_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc_id")).drop("node")


def _merging(links: DataFrame, others: list[DataFrame]) -> DataFrame:
    """The links as links of the components so far, with others, such as the stars that these components are: fewer rounds than from all links anew."""
    return reduce(DataFrame.unionByName, others, links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``n_shingles``, ``component_id`` of each row, and the verified links (``a`` > ``b``) between different sets.

    A component id is the smallest document id reachable by links. Texts without words, null texts and rows
    without an id are linked with nothing (component: their own id, null if they have none). Rows that share an id
    are one document, so what is linked with either is linked with both. Documents with equal sets are one text
    for the join; an empty table gives an empty one. ``doc_id`` must be a long.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    profiles = written(rows.mapInArrow(_profile, "doc_id long, n long, d1 long, d2 long, least array<long>, counts binary"), "profiles")
    counts = spark.sparkContext.broadcast(token_counts(profiles))
    sets = profiles.filter("n > 0 and doc_id is not null")
    nodes = written(sets.groupBy("d1", "d2", "n", "least").agg(F.min("doc_id").alias("doc_id")), "distinct-sets")
    documents = rows.filter("doc_id is not null")
    found = written(prefixes(documents.filter("text is not null"), counts), "prefixes")
    support = found.groupBy("doc_id").agg(F.max("support").alias("support"))
    hashes = written(nodes.join(support, "doc_id").select("doc_id", "n", "support", F.posexplode("least").alias("seed", "hash")), "hub-hashes")
    # A hash that one set has alone makes no pair in any round.
    shared = hashes.groupBy("seed", "hash").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("other")).filter("one < other").select("seed", dealt_anew(F.col("hash")).alias("hash"))
    hashes = written(hashes.withColumn("hash", dealt_anew(F.col("hash"))).join(shared, ["seed", "hash"]), "hub-candidates")
    near, grouped, stars = spark.createDataFrame([], "a long, b long"), None, []
    for turn in range(HUB_ROUNDS):
        each = hashes.withColumn("component", F.col("doc_id")) if grouped is None else _placed(hashes, grouped)
        pairs = written(hub_pairs(each, turn), f"hub-pairs-{turn}")
        new = verified(pairs, documents, f"hub-links-{turn}")
        tried, linked_now = pairs.count(), new.count()
        near = near.unionByName(new.select("a", "b"))
        if linked_now:
            grouped = written(components(_merging(new, stars), f"hub-components-{turn}"), f"hub-groups-{turn}")
            stars = [grouped.select(F.col("node").alias("a"), F.col("component").alias("b"))]
        if linked_now < HUB_YIELD * tried or not tried:
            break
    sets_placed = found.withColumn("component", F.col("doc_id")) if grouped is None else _placed(found, grouped)
    kept = sets_placed.join(nodes.select("doc_id").distinct(), "doc_id", "left_semi")
    pairs = written(cross_pairs(prefix_rows(kept)), "cross-pairs")
    others = written(other_prefixes(of_pairs(documents, pairs, "cross-ids"), counts), "other-prefixes")
    counts.destroy()
    far = verified(written(sharing_all(pairs, others), "candidates"), documents, "cross-links")

    copies = sets.join(nodes.select("d1", "d2", "n", F.col("doc_id").alias("b")), ["d1", "d2", "n"]).select(F.col("doc_id").alias("a"), "b")
    links = near.unionByName(far.select("a", "b")).distinct()
    all_links = components(_merging(far, [*stars, copies]), "near-components")
    out = profiles.filter("n is not null").join(all_links, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")), links
