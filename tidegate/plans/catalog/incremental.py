"""Checkpoints, resume points, incremental batches, backfill."""

from pyspark.sql import functions as F

from tidegate.operators import checkpoints, chunks, dedup
from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.catalog.charges import RUN_ID_SQL, run_id_column
from tidegate.plans.catalog.pages import CHUNKS_DAY, CHUNKS_HOUR, COUNTED_DAY, COUNTED_HOUR, event_chunks
from tidegate.plans.oracle import CHARGES, CHECKPOINTS, LATEST, RUNS, ts_text, with_
from tidegate.schema import CHARGE_COLUMNS

AS_OF = "2024-01-31 00:00:00"


@query(
    "resume_point",
    with_(CHECKPOINTS)
    + f"""SELECT checkpoint_key, {ts_text(f"CASE WHEN checkpoint_key = 'signup' THEN TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY "
    "ELSE last_ts - INTERVAL 5 MINUTE END")} AS resume_at FROM checkpoints""",
)
def resume_point(spark, sf):
    """One checkpoint has lost its timestamp and falls back to the default."""
    table = tables.checkpoints(spark, sf).withColumn(
        "last_ts", F.when(F.col("checkpoint_key") != "signup", F.col("last_ts"))
    )
    default = F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(days=F.lit(7))
    return checkpoints.resume_points(table, "last_ts", default).select("checkpoint_key", "resume_at")


def run_rows(spark, sf):
    """Finished runs of five jobs in the form a checkpoint is folded from."""
    runs = tables.job_runs(spark, sf).where(F.col("status") == "succeeded")
    return runs.select(
        F.col("job_id").alias("checkpoint_key"),
        run_id_column().alias("run_id"),
        F.col("start_time").alias("high_water_mark"),
        F.col("records"),
        F.concat(F.lit("ch_"), F.col("run_no").cast("string")).alias("cursor"),
        F.col("end_time").alias("updated_at"),
        F.to_json(F.struct("run_no", "records")).alias("metadata"),
    )


_FOLDED = f"""
folded AS (
  SELECT job_id AS checkpoint_key, max(start_time) AS last_extracted_timestamp, sum(records)::BIGINT AS records_extracted,
         max(end_time) AS updated_at, arg_max(run_no, (end_time, {RUN_ID_SQL})) AS last_no,
         arg_max(records, (end_time, {RUN_ID_SQL})) AS records_extracted_last_run,
         arg_max({RUN_ID_SQL}, (end_time, {RUN_ID_SQL})) AS updated_by
  FROM job_runs WHERE status = 'succeeded' GROUP BY job_id)"""


@query(
    "checkpoint_upsert",
    with_(RUNS, _FOLDED)
    + f"""SELECT checkpoint_key, {ts_text('last_extracted_timestamp')} AS last_extracted_timestamp,
    'ch_' || last_no AS last_extracted_cursor, records_extracted, records_extracted_last_run,
    {ts_text('updated_at')} AS updated_at, updated_by,
    '{{"run_no":' || last_no || ',"records":' || records_extracted_last_run || '}}' AS metadata FROM folded""",
)
def checkpoint_upsert(spark, sf):
    return checkpoints.fold_checkpoints(run_rows(spark, sf))


@query(
    "checkpoint_metadata",
    with_(RUNS, _FOLDED)
    + """SELECT checkpoint_key, records_extracted, updated_by, last_no AS run_no, records_extracted_last_run AS records
    FROM folded WHERE checkpoint_key = 'job_3'""",
)
def checkpoint_metadata(spark, sf):
    row = checkpoints.checkpoint_row(checkpoints.fold_checkpoints(run_rows(spark, sf)), "job_3")
    parsed = F.from_json("metadata", "run_no BIGINT, records BIGINT").alias("m")
    return row.select("checkpoint_key", "records_extracted", "updated_by", parsed).select(
        "checkpoint_key", "records_extracted", "updated_by", "m.*"
    )


def _requests(spark, sf):
    """Keys to reset: every kind of event that reports errors."""
    kinds = tables.load(spark, sf, "events").where(F.col("event_type") == "error")
    return kinds.select(F.col("event_type").alias("checkpoint_key"), F.lit("bad data").alias("reason")).distinct()


@query(
    "checkpoint_reset",
    with_(CHECKPOINTS)
    + f"""SELECT checkpoint_key, records, {ts_text('last_ts')} AS last_ts FROM checkpoints
    WHERE checkpoint_key NOT IN (SELECT event_type FROM events WHERE event_type = 'error')""",
)
def checkpoint_reset(spark, sf):
    return checkpoints.reset_checkpoints(tables.checkpoints(spark, sf), _requests(spark, sf))


@query(
    "checkpoint_reset_audit",
    with_(CHECKPOINTS)
    + f"""SELECT checkpoint_key, records, {ts_text('last_ts')} AS last_ts, 'bad data' AS reason,
    {ts_text(f"TIMESTAMP '{AS_OF}'")} AS reset_at FROM checkpoints WHERE checkpoint_key = 'error'""",
)
def checkpoint_reset_audit(spark, sf):
    return checkpoints.reset_audit(tables.checkpoints(spark, sf), _requests(spark, sf), F.lit(AS_OF).cast("timestamp"))


def chunk_status(spark, sf):
    """Every eleventh daily chunk failed, starting with the sixth."""
    return event_chunks(spark, sf).withColumn("failed", F.col("chunk_no") % 11 == 5)


@query(
    "safe_high_water_mark",
    with_(CHUNKS_DAY)
    + f"""SELECT count(*) AS chunks, count(*) FILTER (chunk_no % 11 = 5) AS failed_chunks,
    {ts_text('coalesce(min(start_ts) FILTER (chunk_no % 11 = 5), max(end_ts))')} AS high_water_mark FROM chunks""",
)
def safe_high_water_mark(spark, sf):
    return checkpoints.safe_high_water_mark(chunk_status(spark, sf))


@query(
    "backfill_gaps",
    with_(CHUNKS_DAY, COUNTED_DAY)
    + f"""SELECT chunk_no, {ts_text('start_ts')} AS start_ts, {ts_text('end_ts')} AS end_ts, records
    FROM counted WHERE chunk_no % 11 = 5""",
)
def backfill_gaps(spark, sf):
    plan = chunk_status(spark, sf)
    gaps = chunks.missing_chunks(plan, plan.where(~F.col("failed")))
    return gaps.select("chunk_no", "start_ts", "end_ts", "records")


# The stored data ends here; the next run re-reads five minutes and goes to the end.
STORED_UNTIL = 915148800


@query(
    "incremental_batch",
    with_(CHARGES, LATEST.replace("FROM charges)", f"FROM charges WHERE created >= {STORED_UNTIL} - 300)"))
    + f"""SELECT * FROM latest WHERE id NOT IN
      (SELECT id FROM charges WHERE created <= {STORED_UNTIL} AND created >= {STORED_UNTIL} - 300)""",
)
def incremental_batch(spark, sf):
    source = tables.charges(spark, sf)
    stored = source.where(F.col("created") <= STORED_UNTIL)
    end = source.select(F.max("created")).scalar()
    batch = checkpoints.incremental_batch(source, stored, STORED_UNTIL - 300, end, ["id"], dedup.CHARGE_ORDER)
    return batch.select(*CHARGE_COLUMNS)


@query(
    "checkpoint_lag",
    with_(CHECKPOINTS)
    + f"""SELECT checkpoint_key, round(lag, 6) AS lag_hours, round(lag - 0.5, 6) AS age_hours,
    CASE WHEN lag > 4 THEN 'alert' WHEN lag >= 2 THEN 'late' ELSE 'fresh' END AS lag_level,
    CASE WHEN lag - 0.5 > 2 THEN 'alert' ELSE 'ok' END AS age_level
    FROM (SELECT *, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_ts)) / 3600000000 AS lag FROM checkpoints)""",
)
def checkpoint_lag(spark, sf):
    table = tables.checkpoints(spark, sf).withColumn(
        "updated_at", F.col("last_ts") + F.make_dt_interval(mins=F.lit(30))
    )
    return checkpoints.checkpoint_lag(table, F.lit(AS_OF).cast("timestamp"), "last_ts", "updated_at")


@query(
    "extraction_rate",
    with_(RUNS)
    + """SELECT job_id, run_no, records, round(records / ((epoch(end_time) - epoch(start_time)) / 3600), 6)
    AS records_per_hour FROM job_runs""",
)
def extraction_rate(spark, sf):
    return checkpoints.extraction_rate(tables.job_runs(spark, sf)).select(
        "job_id", "run_no", "records", "records_per_hour"
    )


def read_chunks(spark, sf):
    """Hourly chunks as two runs left them: every eleventh failed, and of these every third was read again."""
    counted = event_chunks(spark, sf, 1).select("chunk_no", F.unix_seconds("start_ts").alias("start_s"), F.unix_seconds("end_ts").alias("end_s"), "records")
    first = counted.withColumn("failed", F.col("chunk_no") % 11 == 5)
    again = counted.where("chunk_no % 33 = 5").withColumn("failed", F.lit(False))
    return first.unionByName(again)


@query(
    "chunk_gaps",
    with_(CHUNKS_HOUR, COUNTED_HOUR)
    + """SELECT CAST(floor(epoch(min(start_ts))) AS BIGINT) AS start_s, CAST(floor(epoch(max(end_ts))) AS BIGINT) AS end_s
    FROM (SELECT *, chunk_no - row_number() OVER (ORDER BY chunk_no) AS island FROM counted WHERE chunk_no % 11 = 5 AND chunk_no % 33 <> 5)
    GROUP BY island""",
)
def chunk_gaps(spark, sf):
    """What the next run has to read before anything new."""
    states = read_chunks(spark, sf)
    return chunks.coverage_gaps(states, states.select(F.min("start_s")).scalar(), states.select(F.max("end_s")).scalar())
