"""Queries that write a dataset to the shared folder and read it back."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidegate.operators import dedup, layout, quality, reconcile
from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.catalog.charges import enriched_latest
from tidegate.plans.oracle import CHARGES, ENRICHED, LATEST, day_text, with_
from tidegate.plans.preflight import preflight as run_preflight
from tidegate.session import scratch_path, staged_path
from tidegate.sinks import datasets, maintenance

_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
_EVENT = "event_id, user_id, event_type, value"


def _events(spark, sf):
    return tables.load(spark, sf, "events").select(*_EVENT.split(", "), F.to_date("ts").alias("dt"))


def write_events(spark, sf):
    """Events as a date-partitioned dataset, written once; returns its path."""
    return staged_path(spark, "events", sf, lambda path: datasets.write_partitioned(_events(spark, sf), path))


def written_events(spark, sf):
    return spark.read.parquet(write_events(spark, sf))


_WRITTEN = "id, amount, currency, customer, status, created, completeness_score"


def _monthly(spark, sf):
    return enriched_latest(spark, sf).withColumn("month", F.date_format("dt", "yyyy-MM"))


@query(
    "sink_roundtrip",
    with_(CHARGES, LATEST, ENRICHED) + f"SELECT {_WRITTEN}, {day_text('dt')} AS dt FROM enriched",
)
def sink_roundtrip(spark, sf):
    """Write all enriched charges and read them back.

    The charges span years with few rows a day, so their partitions are months;
    the event datasets below are partitioned by day.
    """
    path = scratch_path(spark, "charges")
    datasets.write_partitioned(_monthly(spark, sf), path, ["month"])
    return spark.read.parquet(path).select(*_WRITTEN.split(", "), "dt")


@query("sink_dry_run", f"SELECT {day_text('ts')} AS dt, count(*) AS records FROM events GROUP BY 1")
def sink_dry_run(spark, sf):
    return datasets.write_partitioned(_events(spark, sf), "unused", dry_run=True)


@query(
    "partition_layout",
    with_(CHARGES)
    + f"""SELECT 'dt=' || {day_text('t')} || '/hour=' || strftime(t, '%H') || '/run_id=run-' || strftime(t, '%Y%m') || '/'
    AS path, count(*) AS records FROM (SELECT make_timestamp(created * 1000000) AS t FROM charges) GROUP BY 1""",
)
def partition_layout(spark, sf):
    rows = tables.charges(spark, sf).select(F.timestamp_seconds("created").alias("t"))
    run_id = F.concat(F.lit("run-"), F.date_format("t", "yyyyMM"))
    path = layout.relative_path(F.to_date("t"), F.hour("t"), run_id)
    return rows.groupBy(path.alias("path")).agg(F.count("*").alias("records"))


@query("latest_partition", f"SELECT {day_text('max(ts)')} AS latest FROM events")
def latest_partition(spark, sf):
    return layout.latest_partition(layout.data_files(spark, write_events(spark, sf)))


@query(
    "file_inventory",
    f"SELECT {day_text('ts')} AS dt, TRUE AS has_files, TRUE AS has_bytes FROM events GROUP BY 1",
)
def file_inventory(spark, sf):
    """The days that have files; how many and how large is up to the writer."""
    files = layout.file_inventory(layout.data_files(spark, write_events(spark, sf)), ["dt"])
    return files.select(F.col("dt").cast("string").alias("dt"), (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


@query("small_file_report", f"SELECT {day_text('ts')} AS dt, 1::BIGINT AS target_files, TRUE AS below_target FROM events GROUP BY 1")
def small_file_report(spark, sf):
    """Days whose files are smaller than the target; here each day would fit into one."""
    report = layout.small_file_report(layout.data_files(spark, write_events(spark, sf)), ["dt"])
    return report.select(F.col("dt").cast("string").alias("dt"), F.col("target_files").cast("bigint").alias("target_files"), (F.col("avg_bytes") < layout.TARGET_BYTES).alias("below_target"))


@query(
    "read_partition_pruned",
    f"""SELECT {_EVENT}, {day_text('ts')} AS dt FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-16'""",
)
def read_partition_pruned(spark, sf):
    rows = written_events(spark, sf)
    return rows.where(F.col("dt") >= F.lit("2024-01-16").cast("date"))


@query(
    "write_verification",
    f"""SELECT {day_text('ts')} AS dt, count(*) AS source_rows, count(*) AS written_rows, TRUE AS verified
    FROM events GROUP BY 1""",
)
def write_verification(spark, sf):
    return layout.verify_write(_events(spark, sf), written_events(spark, sf))


@query(
    "validate_output",
    with_(
        """
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS dt),
counts AS (SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1)"""
    )
    + """SELECT CAST(dt AS VARCHAR) AS dt, coalesce(n, 0) AS records, CASE WHEN n > 0 THEN 'ok' ELSE 'missing' END AS state
    FROM days LEFT JOIN counts USING (dt)""",
)
def validate_output(spark, sf):
    """Expected dates reach beyond the data, so some are missing."""
    days = F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-02-02").cast("date"))
    expected = spark.range(1, numPartitions=1).select(F.explode(days).alias("dt"))
    return layout.validate_output(expected, written_events(spark, sf))


@query(
    "expired_partitions",
    with_(
        """
parts AS (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'raw' WHEN 'view' THEN 'staging' WHEN 'error' THEN 'checkpoints'
  WHEN 'signup' THEN 'run_history' ELSE 'curated' END AS zone, CAST(ts AS DATE) AS dt FROM events),
aged AS (SELECT *, CAST(date_diff('day', dt, DATE '2024-07-05') AS INTEGER) AS age_days, CAST(CASE zone WHEN 'raw' THEN 365
  WHEN 'staging' THEN 30 WHEN 'checkpoints' THEN 180 WHEN 'run_history' THEN 90 END AS INTEGER) AS keep_days FROM parts)"""
    )
    + "SELECT zone, CAST(dt AS VARCHAR) AS dt, age_days, keep_days FROM aged WHERE age_days > keep_days",
)
def expired_partitions(spark, sf):
    zone = (
        F.when(F.col("event_type") == "click", "raw")
        .when(F.col("event_type") == "view", "staging")
        .when(F.col("event_type") == "error", "checkpoints")
        .when(F.col("event_type") == "signup", "run_history")
        .otherwise("curated")
    )
    partitions = _events(spark, sf).select(zone.alias("zone"), "dt").distinct()
    return layout.expired_partitions(partitions, "2024-07-05")


_AUDIT = """
facts AS (SELECT count(*) AS n, count(*) - count(id) AS null_keys, count(*) - count(DISTINCT id) AS dups,
  CASE WHEN count(*) FILTER (completeness_score < 80) / count(*) > 0.20 THEN 'FAILED'
       WHEN count(*) FILTER (completeness_score < 80) / count(*) > 0.05 THEN 'WARNING' ELSE 'PASSED' END AS verdict
  FROM enriched)"""


@query(
    "wac_audit",
    with_(CHARGES, LATEST, ENRICHED, _AUDIT)
    + """SELECT 'row_count' AS "check", CAST(n AS VARCHAR) AS value, n > 0 AS passed FROM facts
    UNION ALL SELECT 'null_keys', CAST(null_keys AS VARCHAR), null_keys = 0 FROM facts
    UNION ALL SELECT 'duplicate_keys', CAST(dups AS VARCHAR), dups = 0 FROM facts
    UNION ALL SELECT 'quality', verdict, verdict <> 'FAILED' FROM facts""",
)
def wac_audit(spark, sf):
    """Write a run, audit its files; it would be committed when every check passes."""
    root = scratch_path(spark, "wac")
    written = datasets.write_run(_monthly(spark, sf), root, "run-1", ["month"])
    return datasets.audit_run(written, None, ["id"], quality.quality_report(written))


@query(
    "latest_committed_run",
    f"""SELECT {_EVENT}, {day_text('ts')} AS dt, 'run-2' AS run_id FROM events""",
)
def latest_committed_run(spark, sf):
    """A run that failed before its commit and its successful repetition: only the latter is read."""
    root = scratch_path(spark, "runs")
    rows = _events(spark, sf)
    datasets.write_run(rows, root, "run-1")
    datasets.write_run(rows, root, "run-2")
    datasets.commit_run(spark, root, "run-2", 0, _AT)
    return datasets.read_committed(spark, root)


@query(
    "idempotent_rerun",
    f"""SELECT {_EVENT}, {day_text('ts')} AS dt FROM events""",
)
def idempotent_rerun(spark, sf):
    """The same run written twice leaves its rows once."""
    root = scratch_path(spark, "rerun")
    rows = _events(spark, sf)
    datasets.write_run(rows, root, "run-1")
    return datasets.write_run(rows, root, "run-1")


@query(
    "reconcile_ids",
    with_(CHARGES)
    + """SELECT id, count(*) AS source_rows, 1::BIGINT AS written_rows FROM charges GROUP BY id HAVING count(*) <> 1""",
)
def reconcile_ids(spark, sf):
    """Source charges against the deduplicated ones: the ids that had copies."""
    source = tables.charges(spark, sf)
    return layout.reconcile_ids(source, dedup.distinct_keys(source, ["id"]), ["id"])


@query(
    "preflight",
    """SELECT * FROM (VALUES ('sink_usable', TRUE, '1 row written and read'), ('checkpoints_readable', TRUE, '0 run read')) v("check", passed, detail)
    UNION ALL SELECT 'source_readable', TRUE, count(*) || ' row read' FROM (SELECT 1 FROM orders LIMIT 1)""",
)
def preflight(spark, sf):
    return run_preflight(
        spark,
        lambda: tables.load(spark, sf, "orders"),
        scratch_path(spark, "preflight"),
        scratch_path(spark, "no-runs-yet"),
    )


def _three_runs(spark, sf, name):
    """The events as three committed runs, each with a few rows of every date."""
    root, rows = scratch_path(spark, name), _events(spark, sf)
    for part in range(3):
        datasets.write_run(rows.where(F.col("event_id") % 3 == part), root, f"run-{part}")
        datasets.commit_run(spark, root, f"run-{part}", 0, _AT)
    return root


@query(
    "compacted_rows",
    f"""SELECT {_EVENT}, {day_text('ts')} AS dt, 'compact-1' AS run_id FROM events""",
)
def compacted_rows(spark, sf):
    """The rows of three runs after a compaction: the same, in the run that replaces them."""
    root = _three_runs(spark, sf, "compaction")
    maintenance.compact(spark, root, "compact-1", _AT)
    return datasets.read_committed(spark, root)


@query(
    "compacted_files",
    f"""SELECT {day_text('ts')} AS dt, count(*) AS records, 1::BIGINT AS files FROM events GROUP BY 1""",
)
def compacted_files(spark, sf):
    """Files that a reader opens for each date after the compaction of three runs."""
    root = _three_runs(spark, sf, "compaction")
    maintenance.compact(spark, root, "compact-1", _AT)
    files = maintenance.visible_files(spark, root).groupBy("dt").agg(F.count("*").alias("files"))
    return datasets.read_committed(spark, root).groupBy("dt").agg(F.count("*").alias("records")).join(files, "dt")


@query(
    "retained_rows",
    f"""SELECT {_EVENT}, {day_text('ts')} AS dt FROM events WHERE ts >= TIMESTAMP '2024-01-11'""",
)
def retained_rows(spark, sf):
    """Readers do not see dates that have expired, whether or not their files are gone."""
    root = _three_runs(spark, sf, "retention")
    at = datetime(2024, 1, 31)
    maintenance.expire(spark, root, "expire-1", at, 20)
    maintenance.vacuum(spark, root, at)
    return datasets.read_committed(spark, root).drop("run_id")


@query(
    "reconcile_changed",
    with_(CHARGES)
    + """SELECT id, created, count(*) AS source_rows, 0::BIGINT AS written_rows FROM charges
    WHERE id <> '' AND created % 7 = 0 AND make_timestamp(created * 1000000)::DATE BETWEEN DATE '1996-03-01' AND DATE '1996-03-31' GROUP BY ALL""",
)
def reconcile_changed(spark, sf):
    """Charges against a copy that lacks a seventh of one month; the other months agree by checksum."""
    keys = ["id", "created"]
    rows = tables.charges(spark, sf).where("id <> ''").select(*keys, F.to_date(F.timestamp_seconds("created")).alias("dt"))
    month = F.col("dt").between(F.lit("1996-03-01").cast("date"), F.lit("1996-03-31").cast("date"))
    copy = rows.where(~(month & (F.col("created") % 7 == 0)))
    return reconcile.reconcile_changed(rows, copy, keys, reconcile.checksums(rows, keys), reconcile.checksums(copy, keys))
