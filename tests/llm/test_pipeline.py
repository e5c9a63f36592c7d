from collections import Counter

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and returns, on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        result = cp.written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, (_, result) in stages.items():
        extra = ["shard", "slot"] if name == "sharding" else []
        assert result.columns == [*cp.COLUMNS, *extra]


def test_quality_rejects_bad_and_keeps_good(spark, stages):
    docs, kept = stages["quality_rules"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r["doc_id"] for r in kept.collect()}
    words = docs.withColumn("n", cp.n_words(F.col("text"))).join(labels, "doc_id").collect()
    good = [r["doc_id"] in left for r in words if r["quality"] == 1 and r["n"] >= 20]
    bad = [r["doc_id"] in left for r in words if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_one_document_of_each_group_stays(spark, stages):
    docs, kept = stages["near_duplicates"]
    groups = {r["doc_id"]: r["component_id"] for r in cp.ngram_join.near_duplicates(docs)[0].collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups.values())) and len(set(groups.values())) < len(groups)


def test_no_benchmark_window_is_left(spark, stages):
    _, clean = stages["decontamination"]
    matched = cp.decontaminate.contaminated_spans(clean, "text", spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert matched.filter(F.size("hit_spans") > 0).count() == 0
    assert clean.filter(F.length("text") != F.col("n_chars")).count() == 0


def test_mix_and_shards_keep_every_row(stages):
    mixed, sharded = stages["sharding"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in sharded.collect())


def test_nulls_repeats_and_empty_tables_pass_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(40)) + "."
    rows = [(None, text, None, None, None), (1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0), (None, None, None, None, None), (4, " ".join(f"long{i}" for i in range(30000)), "en", "b", 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in cp.STAGES:
            docs = cp.written(stage(spark, docs, SF), f"test-{name}")
        left = {r["doc_id"] for r in docs.collect()}
        assert left == ({None, 1, 4} if some else set())


def test_every_operator_has_a_query():
    names = list(queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert {n for n in oracle_sql() if n.startswith("op")} == {"op1_warc", "op2_line_dedup", "op3_decontaminate", "op4_substring_dedup", "op6_ngram_join", "op9_mix"}


def test_unlike_texts_that_share_an_id_stay(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one, other, third = (" ".join(f"{word}{i}" for i in range(60)) for word in ("one", "other", "third"))
    rows = [(5, one, "en", "b", 1), (5, one, "en", "a", 1), (5, other, "en", "a", 1), (6, one, "en", "a", 1), (4, third, "en", "a", 1), (7, other + " end", "en", "a", 1), (8, None, None, None, None)]
    kept = cp.near_duplicates(spark, spark.createDataFrame(rows, schema).repartition(4), SF).collect()
    assert sorted((r["doc_id"], r["text"] or "", r["source"] or "") for r in kept) == sorted([(5, one, "a"), (5, other, "a"), (4, third, "a"), (8, "", "")])
