"""Incremental state as tables: the checkpoint is a fold over the runs of a key."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.times import as_timestamp, hours_between

BUFFER_MINUTES = 5
# Target and alert limits of lag and age in hours.
LAG_TARGET, LAG_ALERT, AGE_ALERT = 2.0, 4.0, 2.0


def fold_checkpoints(runs: DataFrame) -> DataFrame:
    """Current checkpoint per key from its finished runs (``RUN_SCHEMA``).

    The high-water mark is a maximum, so it never moves back; totals add up;
    cursor, metadata and last count come from the latest update. A reset
    (``is_reset``, if the column is there) voids the rows up to its time.
    """
    if "is_reset" in runs.columns:
        resets = runs.where("is_reset").groupBy(F.col("checkpoint_key").alias("reset_key")).agg(F.max("updated_at").alias("reset_at"))
        valid = runs.join(resets, F.col("checkpoint_key") == F.col("reset_key"), "left")
        runs = valid.where(~F.coalesce("is_reset", F.lit(False)) & (F.col("reset_at").isNull() | (F.col("updated_at") > F.col("reset_at"))))
    latest = F.struct("updated_at", "run_id")
    return runs.groupBy("checkpoint_key").agg(
        F.max("high_water_mark").alias("last_extracted_timestamp"),
        F.max_by("cursor", latest).alias("last_extracted_cursor"),
        F.sum("records").alias("records_extracted"),
        F.max_by("records", latest).alias("records_extracted_last_run"),
        F.max("updated_at").alias("updated_at"),
        F.max_by("run_id", latest).alias("updated_by"),
        F.max_by("metadata", latest).alias("metadata"),
    )


def resume_points(
    checkpoints: DataFrame, ts: str, default, buffer_minutes: int = BUFFER_MINUTES
) -> DataFrame:
    """Where each key continues: its timestamp less the buffer, else ``default``."""
    buffer = F.make_dt_interval(mins=F.lit(buffer_minutes))
    return checkpoints.withColumn("resume_at", F.coalesce(F.col(ts) - buffer, as_timestamp(default)))


def resume_point(checkpoints: DataFrame, key: str, ts: str, default, buffer_minutes: int = BUFFER_MINUTES) -> Column:
    """The resume point of one key as a scalar subquery; ``default`` when there is no row."""
    buffer = F.make_dt_interval(mins=F.lit(buffer_minutes))
    found = checkpoints.where(F.col("checkpoint_key") == key).select(F.max(F.col(ts)) - buffer).scalar()
    return F.coalesce(found, as_timestamp(default))


def safe_high_water_mark(chunks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(Specified here.) End of the data that surely arrived.

    That is the start of the earliest failed chunk, or the end of the last chunk
    when none failed. Takes ``start_ts``, ``end_ts``, ``failed``.
    """
    return chunks.groupBy(*(by or [])).agg(
        F.count("*").alias("chunks"),
        F.count_if("failed").alias("failed_chunks"),
        F.coalesce(F.min(F.when(F.col("failed"), F.col("start_ts"))), F.max("end_ts")).alias("high_water_mark"),
    )


def checkpoint_row(checkpoints: DataFrame, key: str) -> DataFrame:
    """All fields of one checkpoint, no row when it does not exist."""
    return checkpoints.where(F.col("checkpoint_key") == key)


def reset_checkpoints(checkpoints: DataFrame, requests: DataFrame) -> DataFrame:
    """Checkpoints without the requested keys. ``requests`` has ``checkpoint_key`` and ``reason``."""
    return checkpoints.join(requests.select("checkpoint_key"), "checkpoint_key", "left_anti")


def reset_audit(checkpoints: DataFrame, requests: DataFrame, as_of: datetime | Column) -> DataFrame:
    """(Specified here.) What a reset removed and why."""
    return checkpoints.join(requests, "checkpoint_key").withColumn("reset_at", as_timestamp(as_of))


def incremental_batch(
    source: DataFrame, stored: DataFrame, start_epoch, end_epoch, keys: list[str], order: list[str]
) -> DataFrame:
    """New rows of a window that overlaps what is stored already.

    Copies inside the batch are reduced before the anti-join, so its left side
    has one row per key and a hot key cannot skew it. A record keeps its ``created``,
    so of what is stored only the window's rows are read: pass ``stored`` with a
    filter on its partitions to skip the others. NULL keys are a value of their own.
    """
    from tidegate.operators.dedup import keep_latest

    inside = (F.col("created") >= start_epoch) & (F.col("created") <= end_epoch)
    batch = keep_latest(source.where(inside), keys, order)
    known = stored.where(inside).select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys])
    return batch.join(known, same, "left_anti")


def checkpoint_lag(
    checkpoints: DataFrame,
    as_of,
    ts: str,
    updated_at: str,
    target_hours: float = LAG_TARGET,
    lag_alert_hours: float = LAG_ALERT,
    age_alert_hours: float = AGE_ALERT,
) -> DataFrame:
    """(Specified here.) Hours behind real time, hours since the last update, and alert levels."""
    now = as_timestamp(as_of)
    lag, age = hours_between(now, F.col(ts)), hours_between(now, F.col(updated_at))
    return checkpoints.select(
        "checkpoint_key",
        lag.alias("lag_hours"),
        age.alias("age_hours"),
        F.when(lag > lag_alert_hours, "alert").when(lag >= target_hours, "late").otherwise("fresh").alias("lag_level"),
        F.when(age > age_alert_hours, "alert").otherwise("ok").alias("age_level"),
    )


def extraction_rate(runs: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """(Specified here.) Records per hour of each run, NULL for a run without duration."""
    hours = hours_between(F.col(end), F.col(start))
    return runs.withColumn("records_per_hour", F.col("records") / F.nullif(hours, F.lit(0.0)))
