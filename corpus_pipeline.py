"""A corpus pipeline: quality rules, near duplicates, decontamination, mixing and sharding.

Every stage takes what its predecessor kept, as a table with the columns of
``documents``; ``run`` writes each stage's rows as Parquet into the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, mixing, ngram_join, quality_lines, sharding
from tidegate.llm.common import n_words, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text has no words and goes; rows that are repeated are judged alike. A table without labels trains nothing,
    and only the base rules decide; an empty table gives an empty one. Columns beyond those of documents are left out.
    """
    field = quality_lines.train(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "labels"), "quality")
    return quality_lines.judge(docs.select(*COLUMNS), "text", field).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; of rows that share id and text one. Rows without an id stay."""
    docs = docs.select(*COLUMNS)
    # Texts that share an id are documents of their own.
    keyed = docs.filter("doc_id is not null").withColumn("key", F.xxhash64("doc_id", "text"))
    joined, _ = ngram_join.near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"))
    placed = joined.select(F.col("doc_id").alias("key"), "component_id").distinct()
    first = keyed.select("key", "doc_id").join(placed, "key").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.*")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    one = F.min(F.struct(*rest, "text")).alias("one")
    kept = keyed.join(first, ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(one).select("doc_id", "one.*")
    return kept.select(*COLUMNS).unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; a document that is mostly benchmark goes.

    Null and empty texts hold no passage and stay as they are; repeated rows lose the same spans. An empty benchmark changes nothing.
    """
    matched = decontaminate.contaminated_spans(docs.select(*COLUMNS), "text", table(spark, sf_dir, "benchmark"))
    clean = decontaminate.removed_spans(matched, "text")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the proportions of the source weights, repeated where a source is short.

    The null source is a source, the last one. Ties of the hash-random key go by size. Null and empty texts have no words, so
    where they stand in their source decides alone. Repeated rows are documents of their own; an empty table gives an empty one.
    """
    sized = docs.select(*COLUMNS, n_words(F.col("text")).alias("size"))
    return mixing.mixed_rows(mixing.mix(sized, "size", "source", ["doc_id", "text"]), "size").select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there.

    Nulls are allowed in any column; rows that are equal in all are numbered and spread. An empty table gives an empty one.
    """
    sized = docs.select(*COLUMNS).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 16)
    return sharding.shuffle_into_shards(sized, "size", SHARDS).drop("size")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: The first stage's trained field, the near-duplicate joins and the seeded shuffle have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
