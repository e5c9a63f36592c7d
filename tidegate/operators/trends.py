"""Daily metrics and their anomalies.

The window functions here run over one row per day (or day and group), after
aggregation: their input is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def volume_rollup(df: DataFrame, amount: str = "amount") -> DataFrame:
    """(Specified here.) Rows and dollars per day and currency with subtotals.

    Rows are reduced to one per (dt, currency) first; only those few are
    expanded into the three grouping levels.
    """
    base = df.groupBy("dt", "currency").agg(
        F.count("*").alias("n"), F.sum(F.col(amount).cast("decimal(20,0)")).alias("cents")
    )
    return base.rollup("dt", "currency").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("n").alias("records"),
        (F.sum("cents").cast("double") / 100.0).alias("total_usd"),
    )


def calendar(daily: DataFrame, day: str, value: str, fill=None) -> DataFrame:
    """Every day from the first to the last one; a day without a row gets ``fill`` as ``value``.

    Days are at most one row each, so everything here is bounded by the calendar.
    """
    bounds = daily.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where(F.col("lo").isNotNull())
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias(day))
    return days.join(daily, day, "left").withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


def volume_drops(daily: DataFrame, day: str = "dt", value: str = "records", drop: float = 0.5) -> DataFrame:
    """(Specified here.) Days whose volume fell by more than ``drop`` against the day before; a day without rows is one of zero."""
    filled = calendar(daily, day, value, 0)
    previous = F.lag(value).over(Window.orderBy(day))
    marked = filled.withColumn("previous", previous)
    return marked.withColumn("alert", F.coalesce(F.col(value) < (1 - drop) * F.col("previous"), F.lit(False)))


def metric_anomalies(
    daily: DataFrame, day: str = "dt", value: str = "value", days: int = 7, limit: float = 3.0, fill=None
) -> DataFrame:
    """(Specified here.) z-score against the preceding ``days`` days; a day without rows has ``fill`` as value.

    Counts need 0 there, so that silence is scored; NULL, for metrics that an empty day does not have, has no part in it.
    The score is NULL until two values lie in those days or when they do not vary.
    """
    trailing = Window.orderBy(day).rowsBetween(-days, -1)
    scored = calendar(daily, day, value, fill).withColumns(
        {"trailing_mean": F.avg(value).over(trailing), "trailing_stddev": F.stddev_samp(value).over(trailing)}
    )
    z = (F.col(value) - F.col("trailing_mean")) / F.nullif(F.col("trailing_stddev"), F.lit(0.0))
    return scored.withColumn("z_score", z).withColumn("anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))
