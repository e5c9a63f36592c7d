"""Partitioned Parquet writes with write, audit, commit.

Layout below a dataset root::

    data/run_id=<run>/dt=<date>/*.parquet     written by the run, overwritten by its retry
    commits/<number>.json                     the commit log, see ``commits``

A run becomes visible through its commit entry; no data file is moved or renamed,
which object stores do slowly and not atomically.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.operators.layout import committed_rows
from tidegate.sinks import commits


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Gather each partition's rows into few files; adaptive execution splits a hot partition.

    The file size follows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    dry_run: bool = False,
) -> DataFrame | None:
    """Write Snappy Parquet; ``mode`` is 'append' or 'overwrite'.

    Overwriting replaces the partitions present in ``df`` and leaves others
    alone. A dry run writes nothing and returns the rows per partition instead.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode}")
    by = ["dt"] if partition_by is None else partition_by
    if dry_run:
        return df.groupBy(*by).agg(F.count("*").alias("records"))
    writer = balanced(df, by).write if by else df.write
    writer = writer.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return None


def run_path(root: str, run_id: str) -> str:
    return f"{root}/data/run_id={run_id}"


def write_run(df: DataFrame, root: str, run_id: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a run, replacing what an earlier attempt of it left, and return it read back."""
    path = run_path(root, run_id)
    by = ["dt"] if partition_by is None else partition_by
    balanced(df, by).write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "snappy"
    ).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def audit_run(
    written: DataFrame, expected_rows: int | None, keys: list[str], verdict: DataFrame | Column
) -> DataFrame:
    """(Specified here.) One row per check of a written run: ``check``, ``value``, ``passed``.

    ``verdict`` is the one-row quality report or its ``quality_check`` as a
    column. Everything is computed from the files, so the checks hold for what a
    reader will see.
    """
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    per_key = written.groupBy(*keys).agg(F.count("*").alias("n"))
    facts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
    )
    enough = F.col("rows") > 0 if expected_rows is None else F.col("rows") == expected_rows
    check = verdict if isinstance(verdict, Column) else verdict.select("quality_check").scalar()
    lines = [("row_count", F.col("rows"), enough)]
    lines += [(name, F.col(name), F.col(name) == 0) for name in ("null_keys", "duplicate_keys")]
    structs = [
        F.struct(F.lit(name).alias("check"), value.cast("string").alias("value"), passed.alias("passed"))
        for name, value, passed in lines
    ]
    structs.append(
        F.struct(F.lit("quality").alias("check"), check.alias("value"), (check != "FAILED").alias("passed"))
    )
    return facts.select(F.explode(F.array(*structs)).alias("line")).select("line.*")


def commit_run(spark: SparkSession, root: str, run_id: str, rows: int, at: datetime) -> int:
    """Make a run visible; the number of its entry. Rests on nothing, so it excludes and is excluded by no other commit."""
    return commits.append(spark, root, commits.new_entry("commit", run_id, at, rows=rows), 0)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet dataset, or no rows when it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def visible(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Of rows with ``run_id`` and perhaps ``dt``, those that a reader of the log's state sees."""
    seen = committed_rows(rows, commits.committed_runs(log))
    if "dt" not in rows.columns:
        return seen
    expired = commits.first_visible_date(log)
    if expired is not None:
        seen = seen.where(F.col("dt") >= F.lit(expired).cast("date"))
    replaced = commits.replaced_parts(log)
    if replaced.isEmpty():
        return seen
    part = F.concat(F.lit("run_id="), F.col("run_id"), F.lit("/dt="), F.date_format("dt", "yyyy-MM-dd"))
    return seen.join(replaced, part == F.col("part"), "left_anti")


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """All rows that are committed, not replaced and not expired, with ``run_id`` and the partition columns.

    The log is read before the folders are listed and does not change afterwards: a reader sees one state of the dataset.
    """
    log = commits.read_log(spark, root)
    return visible(spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data"), log)
