"""Checks before an expensive run: source readable, sink writable, checkpoints readable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sinks import commits


def _source_readable(source: DataFrame) -> str:
    """One row proves that the source can be read."""
    return f"{len(source.take(1))} row read"


def _sink_usable(spark: SparkSession, path: str) -> str:
    """Write and read a one-row probe, as the job's user and through the job's file system; the next probe replaces it."""
    probe = f"{path}/_probe"
    spark.range(1).write.mode("overwrite").parquet(probe)
    rows = len(spark.read.parquet(probe).take(2))
    if rows != 1:
        raise OSError(f"probe returned {rows} rows")
    return "1 row written and read"


def _checkpoints_readable(spark: SparkSession, path: str) -> str:
    return f"{len(commits.read_log(spark, path).take(1))} run read"


def preflight(spark: SparkSession, source: Callable[[], DataFrame], sink: str, runs: str) -> DataFrame:
    """One row per check: ``check``, ``passed``, ``detail``. A failing check does not stop the others."""
    checks = {
        "source_readable": lambda: _source_readable(source()),
        "sink_usable": lambda: _sink_usable(spark, sink),
        "checkpoints_readable": lambda: _checkpoints_readable(spark, runs),
    }
    results = []
    for name, check in checks.items():
        try:
            results.append((name, True, check()))
        except Exception as error:
            results.append((name, False, f"{type(error).__name__}: {str(error).splitlines()[0]}"))
    return spark.createDataFrame(results, "check STRING, passed BOOLEAN, detail STRING")


def exit_code(result: DataFrame) -> int:
    """0 when every check passed, else 1."""
    return 0 if result.where(~F.col("passed")).isEmpty() else 1
