"""Exact quantiles by narrowing a histogram: no task ever holds a group's values. (Specified here.)"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import scratch_path

BINS = 1024


def _same(keys: list[str], prefix: str = "_of_") -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys], F.lit(True))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantile(df: DataFrame, value: str, quantile: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """``quantile`` of a number per group, with linear interpolation between neighbours; NULLs do not count.

    Each round counts the values between the bounds of a wanted rank in ``BINS`` equal bins and keeps the bin that has the
    rank, until the smallest and largest value of the bin are the same. What is shuffled is a row per group and bin; ten bits
    of the range are settled a round. A group without values has no row; NULL is a group of its own.
    """
    keys = by or []
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    place = (F.col("n") - 1) * F.lit(quantile)
    stats = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_value").alias("lo"), F.max("_value").alias("hi")).where("n > 0")
    ranks = F.array_distinct(F.array(F.floor(place), F.ceil(place)))
    wanted = stats.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "n", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below"))
    wanted = _stored(wanted, "quantile-bounds")
    of = [f"_of_{k}" for k in keys]
    done = wanted.where("lo = hi")
    while True:
        active = wanted.where("lo < hi")
        if active.isEmpty():
            break
        inside = rows.join(active, _same(keys) & F.col("_value").between(F.col("lo"), F.col("hi")))
        share = (F.col("_value") - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double")
        bins = inside.withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        counted = bins.groupBy(*of, "n", "rank", "below", "bin").agg(F.count("*").alias("count"), F.min("_value").alias("lo"), F.max("_value").alias("hi"))
        upto = Window.partitionBy(*of, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("below", F.col("below") + F.coalesce(F.sum("count").over(upto), F.lit(0)))
        chosen = placed.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("count")))
        wanted = _stored(chosen.select(*of, "n", "rank", "lo", "hi", "below"), "quantile-bounds")
        done = done.unionByName(wanted.where("lo = hi"))
    found = F.col("lo").cast("double")
    ends = done.groupBy(*of, "n").agg(F.min_by(found, "rank").alias("a"), F.max_by(found, "rank").alias("b"))
    part = place - F.floor(place)
    return ends.select(*[F.col(f"_of_{k}").alias(k) for k in keys], (F.col("a") + (F.col("b") - F.col("a")) * part).alias("quantile"))


def skewed_rows(df: DataFrame, value: str, factor: float = 5.0, by: list[str] | None = None) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the exact median of their group, with that ``median``."""
    keys = by or []
    median = exact_quantile(df, value, 0.5, keys).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("quantile").alias("median"))
    return df.join(median, _same(keys) & (F.col(value) > factor * F.col("median"))).drop(*[f"_of_{k}" for k in keys])
