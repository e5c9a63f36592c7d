"""Sharding by a two-pass external shuffle, with DataFrame operations only.

The first pass scatters rows uniformly by a seeded hash into buckets that fit
in memory. The second shuffles each bucket by Fisher and Yates (``shuffle`` of
Spark, seeded) and numbers its rows behind those of the buckets before it.
Dealing the numbers round the shards gives shards of equal row counts whose
order is random; the result can be written, one file series per shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import written

#: Bytes of rows in a bucket.
BUCKET_BYTES = 16 << 20


def shuffle_into_shards(rows: DataFrame, size: str, shards: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` names the bytes of a row (nulls count as 0); their sum sets the number
    of buckets, which is at least the session's number of shuffle partitions. All columns decide the bucket, so copies of a text
    spread; rows equal in every column are counted, numbered and spread by their number. Row counts of shards are at most one
    apart. Any type that rows can be grouped by is allowed, nulls too; an empty table gives
    an empty one. Other columns keep their names, whatever they are, but those named ``shard`` or ``slot`` are replaced.
    The order depends on the rows, the seed and the number of buckets alone.
    """
    names = rows.columns
    plain = [f"c{i}" for i in range(len(names))]
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = max(int(total // bucket_bytes) + 1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    single = rows.toDF(*plain).withColumn("at", F.xxhash64(F.lit(seed), *plain))
    # Few hashes occur twice, if any; only rows with such a one are grouped.
    repeated = written(single.groupBy("at").count().filter("count > 1").select(F.col("at").alias("again")), "repeated-rows")
    copies = single.join(repeated, F.col("at") == F.col("again"), "left_semi").groupBy("at", *plain).count()
    copies = copies.select(*plain, F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("copy")).withColumn("at", F.xxhash64(F.lit(seed), *plain, "copy"))
    each = single.join(repeated, F.col("at") == F.col("again"), "left_anti").unionByName(copies.drop("copy"))
    bucket = F.pmod("at", F.lit(buckets)).cast("int")
    scattered = each.select(bucket.alias("bucket"), F.struct("at", *plain).alias("row"))
    gathered = scattered.repartition(buckets, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list("row")).alias("sorted"))
    # One sort column keeps the generator's use, and so the order, the same in every run.
    shuffled = gathered.sortWithinPartitions("bucket").select("bucket", F.shuffle("sorted", F.lit(seed)).alias("order"))
    counts = each.groupBy(bucket.alias("in_bucket")).count()
    offsets = counts.select("in_bucket", (F.sum("count").over(Window.orderBy("in_bucket")) - F.col("count")).alias("offset"))
    numbered = shuffled.join(offsets, F.col("bucket") == F.col("in_bucket")).select("offset", F.posexplode("order").alias("position", "row"))
    rank = F.col("offset") + F.col("position")
    return numbered.select(
        *(F.col("row")[c].alias(n) for c, n in zip(plain, names, strict=True) if n not in ("shard", "slot")),
        (rank % shards).cast("int").alias("shard"),
        F.floor(rank / shards).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes every shard into a folder of its own, in slot order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
