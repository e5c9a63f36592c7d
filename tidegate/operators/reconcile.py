"""Comparing two tables by checksums first, so that what agrees is not read by key. (Specified here.)"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.layout import reconcile_ids

BUCKETS = 256


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def checksums(df: DataFrame, keys: list[str], dt: str = "dt", buckets: int = BUCKETS) -> DataFrame:
    """The leaves of the tree: ``rows`` and two order-free checksums of the keys of each date and key bucket.

    Sums, unlike exclusive ors, tell repeated keys. Small enough to be stored with a table and brought up to date by date.
    """
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), *keys).cast("decimal(38,0)"))
    return df.groupBy(F.col(dt).alias("dt"), bucket_of(keys, buckets).alias("bucket")).agg(F.count("*").alias("rows"), wide(1).alias("sum1"), wide(2).alias("sum2"))


def roll_up(sums: DataFrame) -> DataFrame:
    """The level above: one row for each date."""
    return sums.groupBy("dt").agg(*[F.sum(c).alias(c) for c in ("rows", "sum1", "sum2")])


def differing(one: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    """Nodes of two levels whose rows or checksums differ, a missing node being empty."""
    sides = one.select(*by, "rows", "sum1", "sum2").unionByName(other.select(*by, *[(-F.col(c)).alias(c) for c in ("rows", "sum1", "sum2")]))
    left = sides.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("rows", "sum1", "sum2")])
    return left.where("rows <> 0 OR sum1 <> 0 OR sum2 <> 0").select(*by)


def reconcile_changed(source: DataFrame, written: DataFrame, keys: list[str], source_sums: DataFrame, written_sums: DataFrame, dt: str = "dt", buckets: int = BUCKETS) -> DataFrame:
    """The rows of :func:`~tidegate.operators.layout.reconcile_ids`, reading keys only where checksums differ.

    Dates that differ become a filter on ``dt``, which leaves the other partitions of a table unopened; within them, only the
    buckets that differ are compared by key. A key must have the same date on both sides. The driver holds one value for each date that differs.
    """
    dates = [r["dt"] for r in differing(roll_up(source_sums), roll_up(written_sums), ["dt"]).collect()]
    changed = differing(source_sums, written_sums, ["dt", "bucket"]).select(F.col("dt").alias("_dt"), F.col("bucket").alias("_bucket"))
    # An empty date set is a filter that nothing passes.
    wanted = (F.col(dt).isin([d for d in dates if d is not None]) if any(d is not None for d in dates) else F.lit(False)) | (F.col(dt).isNull() if None in dates else F.lit(False))

    def narrowed(df: DataFrame) -> DataFrame:
        rows = df.where(wanted).select(*keys, F.col(dt).alias("_of_dt"), bucket_of(keys, buckets).alias("_of_bucket"))
        same = F.col("_of_dt").eqNullSafe(F.col("_dt")) & (F.col("_of_bucket") == F.col("_bucket"))
        return rows.join(changed, same, "left_semi").select(*keys)

    return reconcile_ids(narrowed(source), narrowed(written), keys)
