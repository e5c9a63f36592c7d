"""Inventories of partitioned datasets: partitions, files, sizes, retention, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.times import as_timestamp

TARGET_BYTES = 128 * 1024 * 1024

# Days each zone is kept.
RETENTION_DAYS = {"raw": 365, "staging": 30, "checkpoints": 180, "run_history": 90}


def relative_path(dt: Column, hour: Column | None = None, run_id: Column | None = None) -> Column:
    """Directory of a row below the dataset root: ``dt=…/hour=…/run_id=…/``."""
    parts = [F.concat(F.lit("dt="), F.date_format(dt, "yyyy-MM-dd"))]
    if hour is not None:
        parts.append(F.concat(F.lit("hour="), F.lpad(hour.cast("string"), 2, "0")))
    if run_id is not None:
        parts.append(F.concat(F.lit("run_id="), run_id))
    return F.concat(F.concat_ws("/", *parts), F.lit("/"))


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file: ``path``, ``length`` and the partition columns. Opens no file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root).drop(
        "content", "modificationTime"
    )


def latest_partition(files: DataFrame, column: str = "dt") -> DataFrame:
    """Highest partition value as text, NULL for an empty dataset."""
    return files.agg(F.max(column).cast("string").alias("latest"))


def file_inventory(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Files and bytes, per partition or in all."""
    return files.groupBy(*(by or [])).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def small_file_report(files: DataFrame, by: list[str], target: int = TARGET_BYTES) -> DataFrame:
    """(Specified here.) Average file size per partition and the file count that would reach the target."""
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target))
    return file_inventory(files, by).select(
        *by,
        "files",
        "bytes",
        F.floor(F.col("bytes") / F.col("files")).alias("avg_bytes"),
        wanted.alias("target_files"),
        (F.col("files") > wanted).alias("compact"),
    )


def expired_partitions(partitions: DataFrame, as_of, zone: str = "zone", dt: str = "dt") -> DataFrame:
    """(Specified here.) Partitions older than their zone allows; unknown zones never expire."""
    days = F.lit(None).cast("int")
    for name, limit in RETENTION_DAYS.items():
        days = F.when(F.col(zone) == name, limit).otherwise(days)
    age = F.datediff(F.to_date(as_timestamp(as_of)), F.col(dt))
    return partitions.select("*", age.alias("age_days"), days.alias("keep_days")).where(
        F.col("age_days") > F.col("keep_days")
    )


def validate_output(expected: DataFrame, written: DataFrame, dt: str = "dt") -> DataFrame:
    """Every expected date with its written rows: 'ok' or 'missing'."""
    counts = written.groupBy(dt).agg(F.count("*").alias("records"))
    return expected.join(counts, dt, "left").select(
        dt,
        F.coalesce("records", F.lit(0)).alias("records"),
        F.when(F.col("records") > 0, "ok").otherwise("missing").alias("state"),
    )


def verify_write(source: DataFrame, written: DataFrame, by: str = "dt") -> DataFrame:
    """Rows per partition in the source and in what was read back."""
    sides = source.select(by, F.lit(1).alias("src"), F.lit(0).alias("out")).unionAll(
        written.select(by, F.lit(0).alias("src"), F.lit(1).alias("out"))
    )
    counts = sides.groupBy(by).agg(F.sum("src").alias("source_rows"), F.sum("out").alias("written_rows"))
    return counts.withColumn("verified", F.col("source_rows") == F.col("written_rows"))


def reconcile_ids(source: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """(Specified here.) Keys whose number of rows differs between two tables.

    Counting both sides in one aggregate needs a single shuffle of partial
    counts; hot keys are combined before it.
    """
    sides = source.select(*keys, F.lit(1).alias("src"), F.lit(0).alias("out")).unionAll(
        written.select(*keys, F.lit(0).alias("src"), F.lit(1).alias("out"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("src").alias("source_rows"), F.sum("out").alias("written_rows"))
    return counts.where(F.col("source_rows") != F.col("written_rows"))


def committed_rows(data: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of committed runs only; leftovers of failed or repeated runs stay invisible.

    The comparison tells the optimizer that the run list is worth turning into
    a partition filter, so folders of other runs are not even opened.
    """
    committed = commits.where(F.col("run_id") > "").select("run_id").distinct()
    return data.join(committed, "run_id", "left_semi")
