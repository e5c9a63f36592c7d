"""Run history: success, durations, failures in a row, overlaps. (Specified here.)

A job's history may be most of the table, so everything that needs run order
goes through ``ordered``: pieces of a job are handled in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.times import as_timestamp
from tidegate.operators.ordered import blocked, ordinal, running

_ORDER = ["start_time", "run_no"]


def latest_run_state(updates: DataFrame) -> DataFrame:
    """Current row per (job_id, run_no) from an append-only log of state changes.

    Of updates at the same time an end state counts before ``running``, then the largest row.
    """
    state = F.struct(*[c for c in updates.columns if c not in ("job_id", "run_no")])
    latest = F.max_by(state, F.struct("updated_at", (F.col("status") != "running").alias("ended"), state))
    return updates.groupBy("job_id", "run_no").agg(latest.alias("state")).select("job_id", "run_no", "state.*")


def runs_with_status(runs: DataFrame, status: str, newest: int | None = None) -> DataFrame:
    """Runs of one status, newest first; ``newest`` makes it a top-k report."""
    ordered = runs.where(F.col("status") == status).orderBy(F.desc("start_time"), F.desc("run_no"))
    return ordered.limit(newest) if newest else ordered


def unexpired(runs: DataFrame, as_of) -> DataFrame:
    return runs.where(F.col("expiry_time") > as_timestamp(as_of))


def success_rate(runs: DataFrame, by: list[str], target: float = 0.99) -> DataFrame:
    """Share of succeeded among finished runs; NULL while all are running."""
    finished = F.count_if(F.col("status") != "running")
    rate = F.count_if(F.col("status") == "succeeded") / F.nullif(finished, F.lit(0))
    return runs.groupBy(*by).agg(
        F.count("*").alias("runs"),
        finished.alias("finished"),
        rate.alias("success_rate"),
        (rate > target).alias("on_target"),
    )


def duration_regressions(runs: DataFrame, trailing: int = 7, factor: float = 2.0) -> DataFrame:
    """Runs that took more than ``factor`` times the mean of the job's ``trailing`` runs before."""
    seconds = F.unix_seconds("end_time") - F.unix_seconds("start_time")
    timed = runs.select("job_id", *_ORDER, seconds.alias("duration_s"))
    placed = blocked(ordinal(timed, ["job_id"], _ORDER), F.col("ordinal"), trailing)
    window = Window.partitionBy("job_id", "_block").orderBy("ordinal").rowsBetween(-trailing, -1)
    marked = placed.withColumn("baseline_s", F.avg("duration_s").over(window)).where("_own")
    slow = F.coalesce(F.col("duration_s") > factor * F.col("baseline_s"), F.lit(False))
    return marked.select("job_id", "run_no", "duration_s", "baseline_s", slow.alias("regression"))


def failure_streaks(runs: DataFrame, at_least: int = 3) -> DataFrame:
    """Unbroken series of failures per job. A running job does not break a series.

    Failures between the same two non-failures share the running count of
    non-failures, which makes the series a plain aggregate.
    """
    finished = runs.where(F.col("status") != "running")
    broken = (F.col("status") != "failed").cast("bigint")
    counted = running(finished, ["job_id"], _ORDER, {"series": ("sum", broken)})
    streaks = counted.where(F.col("status") == "failed").groupBy("job_id", "series").agg(
        F.count("*").alias("failures"),
        F.min("start_time").alias("first_start"),
        F.max("start_time").alias("last_start"),
    )
    return streaks.where(F.col("failures") >= at_least).drop("series")


def overlapping_runs(runs: DataFrame) -> DataFrame:
    """Runs that started before an earlier run of the same job had ended."""
    ended = running(runs, ["job_id"], _ORDER, {"busy_until": ("max", F.col("end_time"))}, inclusive=False)
    return ended.where(F.col("start_time") < F.col("busy_until"))
