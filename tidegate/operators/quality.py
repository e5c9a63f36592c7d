"""Quality metrics of a batch and the verdict that gates its write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the quality gate.
COMPLETENESS_THRESHOLD = {"prod": 80, "dev": 20}
FAILURE_RATE = 0.20
WARNING_RATE = 0.05


def metric_columns(threshold: int) -> list[Column]:
    """The aggregates of a quality report over enriched charges."""
    return [
        F.count("*").alias("total_records"),
        F.count_if("has_customer").alias("records_with_customer"),
        F.count_if("is_fully_refunded").alias("fully_refunded_count"),
        F.count_if(F.col("completeness_score") < threshold).alias("low_completeness_count"),
        F.lit(threshold).cast("bigint").alias("completeness_threshold"),
        F.avg("completeness_score").alias("avg_completeness_score"),
        F.min("amount_usd").alias("min_amount"),
        F.max("amount_usd").alias("max_amount"),
        (F.avg("amount") / 100.0).alias("avg_amount"),
    ]


def quality_metrics(df: DataFrame, threshold: int = 80, by: list[str] | None = None) -> DataFrame:
    """The report in one pass, over everything or per group. One row even when empty."""
    return df.groupBy(*(by or [])).agg(*metric_columns(threshold))


def verdict(total: Column, low: Column, dev: bool = False) -> Column:
    """FAILED without rows; in dev PASSED; else by the share of low rows, limits exclusive."""
    rate = low / F.nullif(total, F.lit(0))
    return (
        F.when(total == 0, "FAILED")
        .when(F.lit(dev), "PASSED")
        .when(rate > FAILURE_RATE, "FAILED")
        .when(rate > WARNING_RATE, "WARNING")
        .otherwise("PASSED")
    )


def quality_report(
    df: DataFrame, dev: bool = False, by: list[str] | None = None, threshold: int | None = None
) -> DataFrame:
    """:func:`quality_metrics` with ``low_quality_rate`` and ``quality_check``."""
    limit = COMPLETENESS_THRESHOLD["dev" if dev else "prod"] if threshold is None else threshold
    total, low = F.col("total_records"), F.col("low_completeness_count")
    return quality_metrics(df, limit, by).select(
        "*",
        (low / F.nullif(total, F.lit(0))).alias("low_quality_rate"),
        verdict(total, low, dev).alias("quality_check"),
    )


def column_completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(Specified here.) NULL and blank rows per column from a single scan."""
    totals = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        *[F.count_if(F.col(c).cast("string") == "").alias(f"blank_{c}") for c in columns],
    )
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"null_{c}").alias("nulls"), F.col(f"blank_{c}").alias("blanks"))
        for c in columns
    ]
    line = totals.select("total", F.explode(F.array(*lines)).alias("line")).select("total", "line.*")
    share = lambda n: n / F.nullif(F.col("total"), F.lit(0))
    return line.select(
        "column_name",
        "total",
        "nulls",
        "blanks",
        share(F.col("nulls")).alias("null_share"),
        share(F.col("nulls") + F.col("blanks")).alias("missing_share"),
    )


def quality_alert(df: DataFrame, score: str, by: list[str], limit: float = 90.0) -> DataFrame:
    """(Specified here.) Average score per group and whether it falls below ``limit``."""
    return df.groupBy(*by).agg(
        F.count("*").alias("records"),
        F.avg(score).alias("avg_score"),
        (F.avg(score) < limit).alias("alert"),
    )


# The partial state of a metric: mergeable, unlike an average.
def partial_metrics(df: DataFrame, by: list[str], value: str = "amount") -> DataFrame:
    """(Specified here.) Mergeable state per run: sum, counts, min, max."""
    return df.groupBy(*by).agg(
        F.count("*").alias("records"),
        F.count(value).alias("value_count"),
        F.sum(F.col(value).cast("decimal(20,0)")).alias("value_sum"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
    )


def merge_metrics(partials: DataFrame, by: list[str]) -> DataFrame:
    """(Specified here.) Merge stored partial states into final metrics, without the rows."""
    merged = partials.groupBy(*by).agg(
        F.sum("records").alias("records"),
        F.sum("value_count").alias("value_count"),
        F.sum("value_sum").alias("value_sum"),
        F.min("value_min").alias("value_min"),
        F.max("value_max").alias("value_max"),
    )
    total = F.col("value_sum").cast("double")
    return merged.select(
        *by,
        "records",
        (total / 100.0).alias("total_usd"),
        (total / F.nullif(F.col("value_count"), F.lit(0)) / 100.0).alias("avg_usd"),
        "value_min",
        "value_max",
    )


def salted_daily(df: DataFrame, day: str, key: str, salts: int = 64) -> DataFrame:
    """(Specified here.) Per-day rows and distinct keys in two stages.

    The distinct keys of a hot day are counted in ``salts`` slices. Slices hold
    disjoint keys, so their counts add up to the unsalted result. NULL keys are
    not counted.
    """
    salt = F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")
    sliced = (
        df.groupBy(day, salt, key)
        .agg(F.count("*").alias("rows"))
        .groupBy(day, "_salt")
        .agg(F.sum("rows").alias("rows"), F.count(key).alias("keys"))
    )
    return sliced.groupBy(day).agg(F.sum("rows").alias("records"), F.sum("keys").alias("distinct_keys"))
