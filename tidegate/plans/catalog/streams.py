"""Streaming queries: each runs to the end of its input and returns what it wrote."""

from pyspark.sql import functions as F

from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.oracle import ts_text
from tidegate.session import scratch_path
from tidegate.sinks.datasets import balanced
from tidegate.streaming import jobs


def _events(spark, sf):
    events = tables.load(spark, sf, "events")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")


def _stage(df, name):
    """Input files of a stream, in the shared folder, one or more per day."""
    path = scratch_path(df.sparkSession, name)
    balanced(df.withColumn("day", F.to_date("ts")), ["day"]).drop("day").write.parquet(path)
    return path


@query("stream_dedup", f"SELECT event_id, {ts_text('ts')} AS ts, event_type FROM events")
def stream_dedup(spark, sf):
    """Every event arrives twice."""
    events = _events(spark, sf)
    path = _stage(events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))), "twice")
    schema = spark.read.parquet(path).schema
    stream = jobs.read_files(spark, path, schema).drop("copy")
    single = jobs.dedup_within(stream, "ts", ["event_id"])
    unique = jobs.run_to_parquet(single, scratch_path(spark, "unique"), scratch_path(spark, "state"))
    return unique.select("event_id", "ts", "event_type")


@query(
    "stream_hourly_quality",
    f"""SELECT {ts_text('w')} AS window_start, {ts_text('w + INTERVAL 1 HOUR')} AS window_end, count(*) AS records,
    count(*) FILTER (event_type = 'error') AS low_quality,
    round(count(*) FILTER (event_type = 'error') / count(*), 6) AS low_quality_rate,
    CASE WHEN count(*) FILTER (event_type = 'error') / count(*) > 0.20 THEN 'FAILED'
      WHEN count(*) FILTER (event_type = 'error') / count(*) > 0.05 THEN 'WARNING' ELSE 'PASSED' END AS quality_check
    FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events)
    GROUP BY w HAVING w + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 5 MINUTE FROM events)""",
)
def stream_hourly_quality(spark, sf):
    """Hours that the watermark has closed; the last one stays open."""
    path = _stage(_events(spark, sf), "events")
    stream = jobs.read_files(spark, path, spark.read.parquet(path).schema)
    windows = jobs.windowed_quality(stream, "ts", F.col("event_type") == "error")
    return jobs.run_to_parquet(windows, scratch_path(spark, "windows"), scratch_path(spark, "state"))


@query(
    "stream_sink",
    f"SELECT event_id, {ts_text('ts')} AS ts, event_type, round(value, 6) AS value FROM events",
)
def stream_sink(spark, sf):
    """Micro-batches written to their own folders and audited."""
    path = _stage(_events(spark, sf), "events")
    stream = jobs.read_files(spark, path, spark.read.parquet(path).schema)
    rows = jobs.run_to_batches(stream, scratch_path(spark, "batches"), scratch_path(spark, "state"), ["event_id"])
    return rows.select("event_id", "ts", "event_type", "value")


@query("stream_dedup_stored", f"SELECT event_id, {ts_text('ts')} AS ts, event_type FROM events")
def stream_dedup_stored(spark, sf):
    """Every event arrives in a first run, and every third again in a second one, long after any watermark."""
    root, state = scratch_path(spark, "stored"), scratch_path(spark, "state")
    events = _events(spark, sf).withColumn("dt", F.to_date("ts"))
    path = _stage(events, "arrivals")
    stream = jobs.read_files(spark, path, events.schema)
    jobs.run_deduplicated(stream, root, state, ["event_id"])
    events.where("event_id % 3 = 0").write.mode("append").parquet(path)
    return jobs.run_deduplicated(stream, root, state, ["event_id"]).select("event_id", "ts", "event_type")


@query(
    "stream_open_silences",
    f"""SELECT key, {ts_text('max(ts)')} AS silent_from FROM (SELECT CAST(user_id AS VARCHAR) AS key, ts FROM events) GROUP BY key
    HAVING max(ts) <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 MINUTE FROM events) - INTERVAL 1 DAY""",
)
def stream_open_silences(spark, sf):
    """Users who had been silent for a day when the stream ended; its last batch knows of all lines."""
    lines = _events_of_users(spark, sf)
    path = scratch_path(spark, "lines")
    lines.coalesce(1).write.parquet(path)
    stream = jobs.read_files(spark, path, lines.schema)
    alerts = jobs.open_silences(stream, "ts", "user_id", minutes=1440)
    return jobs.run_to_parquet(alerts, scratch_path(spark, "silences"), scratch_path(spark, "state"))


def _events_of_users(spark, sf):
    return tables.load(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
