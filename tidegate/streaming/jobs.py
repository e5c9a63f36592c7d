"""Streams run as ``availableNow``: one scheduled run reads what is new and stops."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.operators.quality import FAILURE_RATE, WARNING_RATE
from tidegate.sinks import commits, datasets

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on local disk with a log in the checkpoint, not on the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def dedup_within(stream: DataFrame, ts: str, keys: list[str], delay: str = "5 minutes") -> DataFrame:
    """Drop copies whose event times lie within ``delay``; state older than that is released."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_quality(
    stream: DataFrame, ts: str, low: Column, width: str = "1 hour", delay: str = "5 minutes"
) -> DataFrame:
    """Tumbling windows: records, low-quality records, their rate and the verdict.

    In append mode a window appears once the watermark has passed its end.
    """
    counts = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width))
        .agg(F.count("*").alias("records"), F.count_if(low).alias("low_quality"))
    )
    rate = F.col("low_quality") / F.col("records")
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "records",
        "low_quality",
        rate.alias("low_quality_rate"),
        F.when(rate > FAILURE_RATE, "FAILED").when(rate > WARNING_RATE, "WARNING").otherwise("PASSED").alias(
            "quality_check"
        ),
    )


def open_silences(stream: DataFrame, ts: str, by: str, minutes: int = 15, delay: str = "1 minute") -> DataFrame:
    """Keys that fell silent: ``key``, ``silent_from``, as soon as the watermark is ``minutes`` past the key's last line.

    The state of a key is the time of its last line, and a timer on event time reports it without a further line of
    that key; others move the watermark. A key that speaks again starts anew. NULL is a key of its own.
    """
    import pandas as pd

    limit = minutes * 60_000

    def step(key, frames, state):
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({"key": [key[0]], "silent_from": pd.to_datetime([last], unit="us")})
            return
        latest = max((int(f["micros"].max()) for f in frames), default=None)
        last = max(latest, state.get[0]) if state.exists else latest
        due = last // 1000 + limit
        if due <= state.getCurrentWatermarkMs():
            state.remove()
            yield pd.DataFrame({"key": [key[0]], "silent_from": pd.to_datetime([last], unit="us")})
            return
        state.update((last,))
        state.setTimeoutTimestamp(due)

    lines = stream.withWatermark(ts, delay).select(F.col(by).cast("string").alias("key"), F.col(ts).alias("_event_time"), F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"))
    return lines.groupBy("key").applyInPandasWithState(step, "key STRING, silent_from TIMESTAMP", "last BIGINT", "append", "EventTimeTimeout")


def _new_rows(batch: DataFrame, stored: DataFrame, keys: list[str], dt: str) -> DataFrame:
    """The batch's first row of each key that is not stored yet, comparing within the batch's dates only."""
    dates = [r[0] for r in batch.select(dt).distinct().collect()]
    known = stored.where(F.col(dt).isin(dates)).select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys])
    return batch.dropDuplicates(keys).join(known, same, "left_anti")


def run_deduplicated(stream: DataFrame, root: str, checkpoint: str, keys: list[str], dt: str = "dt") -> DataFrame:
    """Append everything available to a committed dataset, each key once for good, and return what readers see.

    A watermark forgets; a copy that arrives a day late, in another run, is still found in what is stored. Each
    micro-batch is a run of its own: it is joined with the committed partitions of its dates (a copy keeps its
    date), written and committed, and a batch that is replayed after its commit adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run_id = batch.sparkSession, f"batch-{batch_id}"
        log = commits.read_log(spark, root)
        if batch.isEmpty() or not commits.committed_runs(log).where(F.col("run_id") == run_id).isEmpty():
            return
        stored = datasets.read_committed(spark, root) if commits.versions(spark, root) else None
        fresh = batch.dropDuplicates(keys) if stored is None else _new_rows(batch, stored, keys, dt)
        written = datasets.write_run(fresh, root, run_id, [dt])
        rows = written.count()
        datasets.commit_run(spark, root, run_id, rows, datetime.now(timezone.utc))

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return datasets.read_committed(stream.sparkSession, root)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything available to Parquet, exactly once, and return it read back."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with rocksdb(stream.sparkSession):
        query = writer.start()
        query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def _write_batch(root: str, keys: list[str]):
    def write(batch: DataFrame, batch_id: int) -> None:
        """A replayed batch overwrites its own folder, so retries add nothing."""
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        # One pass writes both kinds of rows; the folder names tell them apart.
        data = f"{root}/data/batch_id={batch_id}"
        batch.withColumn("rejected", missing).write.mode("overwrite").partitionBy("rejected").parquet(data)
        written = batch.sparkSession.read.schema(batch.schema.add("rejected", "boolean")).parquet(data)
        audit = written.agg(F.count("*").alias("rows"), F.count_if("rejected").alias("null_keys"))
        audit.coalesce(1).write.mode("overwrite").parquet(f"{root}/audit/batch_id={batch_id}")

    return write


def run_to_batches(stream: DataFrame, root: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Idempotent sink: one folder per micro-batch with an audit row. Returns the valid rows of audited batches.

    Rows with a NULL key are kept aside as rejects, see :func:`rejected_rows`; the audit counts both.
    """
    query = (
        stream.writeStream.foreachBatch(_write_batch(root, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _audited(stream.sparkSession, root, stream.schema).where(~F.col("rejected")).drop("rejected")


def _audited(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    audit = spark.read.option("basePath", f"{root}/audit").parquet(f"{root}/audit")
    layout = schema.add("batch_id", "long").add("rejected", "boolean")
    data = spark.read.schema(layout).option("basePath", f"{root}/data").parquet(f"{root}/data")
    return data.join(audit.select("batch_id"), "batch_id", "left_semi")


def rejected_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Rows with a NULL key of all audited batches below ``root``."""
    return _audited(spark, root, schema).where("rejected").drop("rejected")
