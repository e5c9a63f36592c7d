"""States of runs from start to end, as an append-only log with a lease.

Layout: ``<root>/states/``, Parquet, one row for each change. A run appends ``running`` when it starts and each time it
renews its lease, and ``succeeded``, ``gated`` or ``failed`` when it ends. A run that was killed appends nothing more: it
is told from one that still runs by its lease.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.times import as_timestamp
from tidegate.operators.runs import latest_run_state
from tidegate.sinks.datasets import read_or_empty

STATE = "job_id STRING, run_no STRING, status STRING, start_time TIMESTAMP, end_time TIMESTAMP, lease_until TIMESTAMP, updated_at TIMESTAMP, records BIGINT, detail STRING"


class RunState:
    """One run's rows in the log; as a context manager it notes an exception as a failure."""

    def __init__(self, spark: SparkSession, root: str, job_id: str, run_id: str, as_of: datetime, lease_minutes: int) -> None:
        self.spark, self.root, self.job_id, self.run_id = spark, root, job_id, run_id
        self.started, self.lease, self.ended = as_of, timedelta(minutes=lease_minutes), False
        self.clock = datetime.now(timezone.utc)

    def _now(self) -> datetime:
        """The run's own time: what it was started with, and what has passed since."""
        return self.started + (datetime.now(timezone.utc) - self.clock)

    def _append(self, status: str, detail: str | None = None, records: int | None = None) -> None:
        now, over = self._now(), status != "running"
        self.spark.range(1, numPartitions=1).select(
            F.lit(self.job_id).alias("job_id"),
            F.lit(self.run_id).alias("run_no"),
            F.lit(status).alias("status"),
            as_timestamp(self.started).alias("start_time"),
            (as_timestamp(now) if over else F.lit(None).cast("timestamp")).alias("end_time"),
            (F.lit(None).cast("timestamp") if over else as_timestamp(now + self.lease)).alias("lease_until"),
            as_timestamp(now).alias("updated_at"),
            F.lit(records).cast("bigint").alias("records"),
            F.lit(detail).cast("string").alias("detail"),
        ).write.mode("append").parquet(f"{self.root}/states")

    def __enter__(self) -> RunState:
        self._append("running")
        return self

    def renew(self) -> None:
        self._append("running")

    def end(self, status: str, detail: str, records: int = 0) -> None:
        self._append(status, detail, records)
        self.ended = True

    def __exit__(self, kind, error, trace) -> None:
        if isinstance(error, Exception) and not self.ended:
            self.end("failed", f"{type(error).__name__}: {str(error)[:500]}")


def with_lost(states: DataFrame, as_of) -> DataFrame:
    """Latest states in which a running run whose lease has run out is ``lost``, ended when the lease did."""
    lost = (F.col("status") == "running") & (F.col("lease_until") < as_timestamp(as_of))
    over = F.when(lost, F.col("lease_until")).otherwise(F.col("end_time"))
    return states.withColumn("end_time", over).withColumn("status", F.when(lost, "lost").otherwise(F.col("status")))


def run_states(spark: SparkSession, root: str, as_of) -> DataFrame:
    """Where every run of the dataset stands: ``running``, ``succeeded``, ``gated``, ``failed`` or ``lost``."""
    return with_lost(latest_run_state(read_or_empty(spark, f"{root}/states", STATE)), as_of)
