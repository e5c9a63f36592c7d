import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import mixing, sharding

SCHEMA = "doc_id long, text string, source string, size long"


def targets(sizes, weights=(5.0, 2.0, 1.0), volume=1.5, most=2.0):
    """Shares the budget by weight, caps, and shares the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, capped, budget = {}, set(), volume * sum(sizes.values())
    while True:
        rest = budget - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        got = {s: most * sizes[s] if s in capped else rest * weight[s] / total for s in names}
        new = {s for s in names if s not in capped and got[s] >= most * sizes[s]}
        if not new:
            return got
        capped |= new
        if len(capped) == len(names):
            return {s: most * sizes[s] for s in names}


@pytest.fixture(scope="module")
def documents():
    draw = random.Random(3)
    sources = ["a", "b", "c", "ü", None, "z", ""]
    rows = [(i, f"t{i}", draw.choices(sources, weights=[30, 4, 3, 2, 5, 1, 1])[0], draw.choice([0, 1, 5, 40, 400])) for i in range(700)]
    return rows + rows[:20] + [(None, None, "a", 7), (None, None, None, 0)]


def test_mix_hits_the_targets_exactly(frame, documents):
    out = mixing.mix(frame(documents, SCHEMA), "size", "source", ["doc_id"]).collect()
    assert len(out) == len(documents)
    sizes = defaultdict(int)
    for _, _, source, size in documents:
        sizes[source] += size
    expected = targets(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r["row"] == "x" and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        words = r["epochs"] * r["size"] + r["part"]
        assert 0 <= words <= 2 * r["size"]
        taken[r["source"]] += words
    for source, words in taken.items():
        assert words == int(expected[source] + 1e-6)


def test_mix_agrees_between_runs_and_layouts(frame, documents):
    runs = [
        Counter((r["doc_id"], r["source"], r["size"], r["epochs"], r["part"]) for r in mixing.mix(frame(documents, SCHEMA, n), "size", "source", ["doc_id"]).collect()) for n in (2, 5)
    ]
    assert runs[0] == runs[1]


def test_mix_of_an_empty_table_and_of_no_words(frame):
    assert mixing.mix(frame([], SCHEMA), "size", "source", ["doc_id"]).count() == 0
    assert [(r["epochs"], r["part"]) for r in mixing.mix(frame([(1, "", "a", 0)], SCHEMA), "size", "source", ["doc_id"]).collect()] == [(0, 0)]


def test_mixed_rows_repeat_whole_rows(frame):
    rows = [(i, "t", "a" if i < 40 else "b", 10) for i in range(100)]
    out = mixing.mixed_rows(mixing.mix(frame(rows, SCHEMA), "size", "source", ["doc_id"]), "size")
    assert set(out.columns) == {"doc_id", "text", "source", "size", "row", "take"}
    words = {r["source"]: r["words"] for r in out.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    expected = targets({"a": 400, "b": 600})
    assert all(abs(words[s] - expected[s]) <= 5 for s in words)
    assert Counter(r["doc_id"] for r in out.collect()).most_common(1)[0][1] <= 2


@pytest.mark.parametrize("bucket_bytes", [500, 1 << 20])
def test_shards_are_even_gapless_and_mixed(frame, documents, bucket_bytes):
    table = frame(documents, SCHEMA)
    out = sharding.shuffle_into_shards(table, "size", 7, bucket_bytes=bucket_bytes).collect()
    assert Counter((r["doc_id"], r["text"], r["source"], r["size"], r["row"]) for r in out) == Counter((*d, "x") for d in documents)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ordered = [r["doc_id"] for r in sorted(out, key=lambda r: (r["slot"], r["shard"])) if r["doc_id"] is not None]
    rising = sum(a < b for a, b in zip(ordered, ordered[1:], strict=False))
    assert 0.4 < rising / len(ordered) < 0.6


def test_shards_agree_between_runs(frame, documents):
    def run(partitions):
        out = sharding.shuffle_into_shards(frame(documents, SCHEMA, partitions), "size", 7, bucket_bytes=500)
        return Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in out.collect())

    assert run(2) == run(5)


def test_shards_of_an_empty_table_and_more_shards_than_rows(frame):
    assert sharding.shuffle_into_shards(frame([], SCHEMA), "size", 4).count() == 0
    out = sharding.shuffle_into_shards(frame([(1, None, None, None), (2, "x", "a", 1)], SCHEMA), "size", 9).collect()
    assert sorted((r["shard"], r["slot"]) for r in out) == [(0, 0), (1, 0)]


def test_equal_rows_spread_over_the_buckets(frame):
    copies, others = 20_000, 500
    rows = [(7, "same", "a", 100)] * copies + [(i, f"t{i}", "b", 100) for i in range(others)]
    out = sharding.shuffle_into_shards(frame(rows, SCHEMA), "size", 8, bucket_bytes=20_000)
    got = out.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"), F.count_if(F.col("doc_id") == 7).alias("same")).collect()
    assert sum(r["n"] for r in got) == copies + others and sum(r["same"] for r in got) >= copies
    assert all(r["last"] == r["n"] - 1 for r in got) and max(r["n"] for r in got) - min(r["n"] for r in got) <= 1
    # The others lie anywhere between the copies.
    places = sorted(r["slot"] for r in out.filter("source = 'b'").collect())
    assert places[0] < 300 and places[-1] > (copies + others) / 8 - 300


def test_columns_may_have_any_name(frame):
    rows = frame([(i, "t", "a", i) for i in range(20)], SCHEMA).withColumnsRenamed({"doc_id": "at", "text": "bucket", "source": "row_", "row": "shard"})
    out = sharding.shuffle_into_shards(rows.withColumn("position", F.lit(1)), "size", 3)
    assert out.columns == ["at", "bucket", "row_", "size", "position", "shard", "slot"]
    assert sorted(r["at"] for r in out.collect()) == list(range(20)) and {r["shard"] for r in out.collect()} == {0, 1, 2}


def test_written_shards_keep_slot_order(spark, frame, documents, tmp_path):
    sharding.write_shards(sharding.shuffle_into_shards(frame(documents, SCHEMA), "size", 4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards" / "shard=2")).collect()
    assert [r["slot"] for r in back] == list(range(len(back)))
