"""Requests, runs and logs."""

from pyspark.sql import functions as F

from tidegate.operators import logs, quantiles, requests, runs
from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.run_states import with_lost
from tidegate.plans.oracle import LOG, REQUESTS, RUNS, day_text, ts_text, with_

_HEALTH = """count(*) AS total_requests, count(*) FILTER (status = 429) AS total_rate_limit_hits,
  count(*) FILTER (is_retry) AS total_retries,
  round(count(*) FILTER (status = 429) / count(*), 6) AS rate_limit_hit_rate FROM request_log"""


@query("request_health", with_(REQUESTS) + f"SELECT {_HEALTH}")
def request_health(spark, sf):
    return requests.request_health(tables.request_log(spark, sf))


@query("request_health_daily", with_(REQUESTS) + f"SELECT {day_text('ts')} AS dt, {_HEALTH} GROUP BY 1")
def request_health_daily(spark, sf):
    return requests.request_health(tables.request_log(spark, sf).withColumn("dt", F.to_date("ts")), ["dt"])


@query(
    "request_alerts",
    with_(REQUESTS)
    + f"""SELECT dt, round(hit, 6) AS rate_limit_hit_rate, round(ms, 6) AS avg_response_ms, round(retry, 6) AS retry_rate,
    round(per, 6) AS records_per_request, round(per / 100, 6) AS page_fill,
    CASE WHEN hit > 0.05 THEN 'alert' WHEN hit >= 0.01 THEN 'watch' ELSE 'ok' END AS rate_limit_level,
    CASE WHEN ms > 2000 THEN 'alert' WHEN ms >= 500 THEN 'watch' ELSE 'ok' END AS response_level,
    CASE WHEN retry > 0.10 THEN 'alert' WHEN retry >= 0.05 THEN 'watch' ELSE 'ok' END AS retry_level,
    CASE WHEN per / 100 >= 0.9 THEN 'ok' ELSE 'watch' END AS page_fill_level
    FROM (SELECT {day_text('ts')} AS dt, count(*) FILTER (status = 429) / count(*) AS hit, avg(duration_ms) AS ms,
      count(*) FILTER (is_retry) / count(*) AS retry, sum(records) / count(*) AS per FROM request_log GROUP BY 1)""",
)
def request_alerts(spark, sf):
    log = tables.request_log(spark, sf).withColumn("dt", F.to_date("ts"))
    return requests.request_alerts(log, by=["dt"])


_RUN = f"""job_id, run_no, status, records, {ts_text('start_time')} AS start_time"""


def _narrow(df):
    return df.select("job_id", "run_no", "status", "records", "start_time")


@query("runs_by_status", with_(RUNS) + f"SELECT {_RUN} FROM job_runs WHERE status = 'failed'")
def runs_by_status(spark, sf):
    return _narrow(runs.runs_with_status(tables.job_runs(spark, sf), "failed"))


@query(
    "runs_newest_failed",
    with_(RUNS)
    + f"""SELECT {_RUN.replace("AS start_time", "AS start_text")} FROM job_runs WHERE status = 'failed'
    ORDER BY start_time DESC, run_no DESC LIMIT 20""".replace("start_text", '"start_time"').replace(
        "ORDER BY start_time", "ORDER BY job_runs.start_time"
    ),
)
def runs_newest_failed(spark, sf):
    return _narrow(runs.runs_with_status(tables.job_runs(spark, sf), "failed", newest=20))


@query(
    "run_history_state",
    with_(RUNS)
    + f"""SELECT job_id, run_no, status,
    {ts_text("CASE WHEN status = 'running' THEN start_time ELSE end_time END")} AS updated_at FROM job_runs""",
)
def run_history_state(spark, sf):
    """A row when a run starts, another when it ends; the latest one is its state."""
    log = tables.job_runs(spark, sf)
    begun = log.select("job_id", "run_no", F.lit("running").alias("status"), F.col("start_time").alias("updated_at"))
    ended = log.where(F.col("status") != "running").select(
        "job_id", "run_no", "status", F.col("end_time").alias("updated_at")
    )
    return runs.latest_run_state(begun.unionByName(ended))


@query("runs_unexpired", with_(RUNS) + f"SELECT {_RUN} FROM job_runs WHERE expiry_time > TIMESTAMP '1999-01-01'")
def runs_unexpired(spark, sf):
    return _narrow(runs.unexpired(tables.job_runs(spark, sf), "1999-01-01"))


@query(
    "job_success_rate",
    with_(RUNS)
    + f"""SELECT job_id, {day_text('start_time')} AS dt, count(*) AS runs, count(*) FILTER (status <> 'running') AS finished,
    round(count(*) FILTER (status = 'succeeded') / nullif(count(*) FILTER (status <> 'running'), 0), 6) AS success_rate,
    count(*) FILTER (status = 'succeeded') / nullif(count(*) FILTER (status <> 'running'), 0) > 0.99 AS on_target
    FROM job_runs GROUP BY 1, 2""",
)
def job_success_rate(spark, sf):
    history = tables.job_runs(spark, sf).withColumn("dt", F.to_date("start_time"))
    return runs.success_rate(history, ["job_id", "dt"])


@query(
    "duration_regression",
    with_(RUNS)
    + """SELECT job_id, run_no, d AS duration_s, round(b, 6) AS baseline_s, coalesce(d > 2 * b, FALSE) AS regression
    FROM (SELECT *, avg(d) OVER (PARTITION BY job_id ORDER BY start_time, run_no ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS b
      FROM (SELECT *, CAST(epoch(end_time) - epoch(start_time) AS BIGINT) AS d FROM job_runs))""",
)
def duration_regression(spark, sf):
    return runs.duration_regressions(tables.job_runs(spark, sf))


@query(
    "consecutive_failures",
    with_(RUNS)
    + f"""SELECT job_id, count(*) AS failures, {ts_text('min(start_time)')} AS first_start,
    {ts_text('max(start_time)')} AS last_start FROM (
      SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time, run_no)
        - row_number() OVER (PARTITION BY job_id, status ORDER BY start_time, run_no) AS island
      FROM job_runs WHERE status <> 'running') WHERE status = 'failed' GROUP BY job_id, island HAVING count(*) >= 3""",
)
def consecutive_failures(spark, sf):
    return runs.failure_streaks(tables.job_runs(spark, sf))


@query(
    "overlapping_runs",
    with_(RUNS)
    + f"""SELECT job_id, run_no, {ts_text('start_time')} AS start_time, {ts_text('busy')} AS busy_until FROM (
      SELECT *, max(end_time) OVER (PARTITION BY job_id ORDER BY start_time, run_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy FROM job_runs) WHERE start_time < busy""",
)
def overlapping_runs(spark, sf):
    return runs.overlapping_runs(tables.job_runs(spark, sf)).select("job_id", "run_no", "start_time", "busy_until")


@query(
    "log_parse",
    with_(LOG)
    + f"""SELECT 'line-' || event_id AS run_id, {ts_text('ts')} AS ts, level, 'done: ' || operation AS message, operation,
    duration_ms, partition_id, NULL::VARCHAR AS corrupt FROM log""",
)
def log_parse(spark, sf):
    parsed = logs.parse_log(tables.log_text(tables.log_lines(spark, sf)))
    return parsed.select("run_id", "ts", "level", "message", "operation", "duration_ms", "partition_id", "corrupt")


@query(
    "log_errors",
    with_(LOG) + f"SELECT event_id, {ts_text('ts')} AS ts, operation FROM log WHERE level = 'ERROR'",
)
def log_errors(spark, sf):
    return logs.error_lines(tables.log_lines(spark, sf)).select("event_id", "ts", "operation")


@query(
    "log_error_rate",
    with_(LOG)
    + """SELECT partition_id, count(*) AS lines, count(*) FILTER (level = 'ERROR') AS errors,
    round(count(*) FILTER (level = 'ERROR') / count(*), 6) AS error_rate,
    count(*) FILTER (level = 'ERROR') / count(*) > 0.01 AS alert FROM log GROUP BY partition_id""",
)
def log_error_rate(spark, sf):
    return logs.error_rate(tables.log_lines(spark, sf), ["partition_id"])


@query(
    "log_operation_stats",
    with_(LOG)
    + """SELECT operation, count(*) AS lines, round(avg(duration_ms), 6) AS avg_ms, max(duration_ms) AS max_ms
    FROM log GROUP BY operation""",
)
def log_operation_stats(spark, sf):
    return logs.operation_stats(tables.log_lines(spark, sf))


@query(
    "slowest_partitions",
    with_(LOG)
    + "SELECT partition_id, max(duration_ms) AS max_ms FROM log GROUP BY 1 ORDER BY max_ms DESC, partition_id LIMIT 5",
)
def slowest_partitions(spark, sf):
    return logs.slowest(tables.log_lines(spark, sf), k=5)


@query(
    "log_gaps",
    with_(LOG)
    + f"""SELECT operation, {ts_text('prev')} AS silent_from, {ts_text('ts')} AS silent_until,
    round((epoch_us(ts) - epoch_us(prev)) / 1e6, 6) AS gap_seconds FROM (
      SELECT *, lag(ts) OVER (PARTITION BY operation ORDER BY ts) AS prev FROM log)
    WHERE epoch_us(ts) - epoch_us(prev) > 900000000""",
)
def log_gaps(spark, sf):
    return logs.silences(tables.log_lines(spark, sf), by=["operation"])


@query(
    "log_sample",
    with_(LOG)
    + f"""SELECT event_id, {ts_text('ts')} AS ts, operation FROM (
      SELECT *, row_number() OVER (PARTITION BY operation ORDER BY ts, event_id) AS rn FROM log) WHERE rn % 100 = 0""",
)
def log_sample(spark, sf):
    sampled = logs.sample_every(tables.log_lines(spark, sf), order=["ts", "event_id"])
    return sampled.select("event_id", "ts", "operation")


def timing_lines(spark, sf):
    """Two operations per run, one after the other; failed runs fail in the second, running ones never end it."""
    history = tables.job_runs(spark, sf)
    half = F.timestamp_seconds(
        F.unix_seconds("start_time") + F.floor((F.unix_seconds("end_time") - F.unix_seconds("start_time")) / 2)
    )
    line = lambda seq, ts, text: F.struct(F.lit(seq).alias("seq"), ts.alias("ts"), F.lit(text).alias("message"))
    first = [line(1, F.col("start_time"), "Starting: extract"), line(2, half, "Completed: extract")]
    second = F.when(F.col("status") == "succeeded", F.array(line(4, F.col("end_time"), "Completed: write"))).when(
        F.col("status") == "failed", F.array(line(4, F.col("end_time"), "Failed: write"))
    ).otherwise(F.array().cast("array<struct<seq:int,ts:timestamp,message:string>>"))
    lines = F.concat(F.array(*first, line(3, half, "Starting: write")), second)
    return history.select("job_id", F.col("run_no").cast("string").alias("run_id"), F.explode(lines).alias("l")).select("job_id", "run_id", "l.*")


@query(
    "log_durations",
    with_(
        RUNS,
        """
halved AS (
  SELECT *, make_timestamp((epoch(start_time)::BIGINT + (epoch(end_time)::BIGINT - epoch(start_time)::BIGINT) // 2)
    * 1000000) AS half FROM job_runs),
lines AS (
  SELECT job_id, run_no, 1 AS seq, start_time AS ts, 'extract' AS operation, NULL AS outcome FROM halved
  UNION ALL SELECT job_id, run_no, 2, half, 'extract', 'completed' FROM halved
  UNION ALL SELECT job_id, run_no, 3, half, 'write', NULL FROM halved
  UNION ALL SELECT job_id, run_no, 4, end_time, 'write', CASE status WHEN 'failed' THEN 'failed' ELSE 'completed' END
    FROM halved WHERE status <> 'running'),
numbered AS (
  SELECT *, count(*) FILTER (outcome IS NULL) OVER (PARTITION BY job_id, run_no, operation ORDER BY ts, seq
    ROWS UNBOUNDED PRECEDING) AS attempt FROM lines)""",
    )
    + f"""SELECT job_id, run_no::VARCHAR AS run_id, operation, attempt, {ts_text('min(ts) FILTER (outcome IS NULL)')} AS started_at,
    {ts_text('max(ts) FILTER (outcome IS NOT NULL)')} AS ended_at, coalesce(max(outcome), 'open') AS outcome,
    (epoch_us(max(ts) FILTER (outcome IS NOT NULL)) - epoch_us(min(ts) FILTER (outcome IS NULL))) // 1000 AS duration_ms
    FROM numbered GROUP BY job_id, run_no, operation, attempt""",
)
def log_durations(spark, sf):
    return logs.operation_times(timing_lines(spark, sf), ["ts", "seq"])


@query(
    "run_states_lost",
    with_(RUNS)
    + f"""SELECT job_id, run_no, CASE WHEN lost THEN 'lost' ELSE status END AS status,
    {ts_text("CASE WHEN lost THEN start_time + INTERVAL 1 HOUR WHEN status <> 'running' THEN end_time END")} AS end_time
    FROM (SELECT *, status = 'running' AND start_time + INTERVAL 1 HOUR < TIMESTAMP '1996-06-01' AS lost FROM job_runs)""",
)
def run_states_lost(spark, sf):
    """A run that began and never ended is lost once its lease has run out."""
    log = tables.job_runs(spark, sf)
    lease = F.col("start_time") + F.make_dt_interval(hours=F.lit(1))
    begun = log.select("job_id", "run_no", F.lit("running").alias("status"), F.lit(None).cast("timestamp").alias("end_time"), lease.alias("lease_until"), F.col("start_time").alias("updated_at"))
    ended = log.where("status <> 'running'").select("job_id", "run_no", "status", "end_time", F.lit(None).cast("timestamp").alias("lease_until"), F.col("end_time").alias("updated_at"))
    latest = runs.latest_run_state(begun.unionByName(ended))
    return with_lost(latest, "1996-06-01").select("job_id", "run_no", "status", "end_time")


@query(
    "log_silences_open",
    with_(LOG)
    + f"""SELECT operation, partition_id, {ts_text('prev')} AS silent_from, {ts_text('ts')} AS silent_until,
    round((epoch_us(coalesce(ts, TIMESTAMP '2024-01-20')) - epoch_us(prev)) / 1e6, 6) AS gap_seconds FROM (
      SELECT operation, partition_id, ts, lag(ts) OVER (PARTITION BY operation, partition_id ORDER BY ts) AS prev FROM log WHERE ts <= TIMESTAMP '2024-01-20'
      UNION ALL SELECT operation, partition_id, NULL, max(ts) FROM log WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1, 2)
    WHERE epoch_us(coalesce(ts, TIMESTAMP '2024-01-20')) - epoch_us(prev) > 3600000000""",
)
def log_silences_open(spark, sf):
    """Silences of over an hour up to a moment at which some still go on."""
    return logs.silences(tables.log_lines(spark, sf), by=["operation", "partition_id"], minutes=60, as_of="2024-01-20")


@query(
    "lineitem_medians",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice::DOUBLE), 6) AS quantile FROM lineitem GROUP BY 1, 2""",
)
def lineitem_medians(spark, sf):
    """Exact medians of large groups, none of which is ever in one task."""
    return quantiles.exact_quantile(tables.load(spark, sf, "lineitem"), "l_extendedprice", 0.5, ["l_returnflag", "l_linestatus"])


@query(
    "task_skew",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, round(median, 6) AS median FROM (SELECT *, median(l_extendedprice::DOUBLE) OVER (PARTITION BY l_returnflag) AS median FROM lineitem)
    WHERE l_extendedprice > 1.9 * median""",
)
def task_skew(spark, sf):
    """Line items as tasks of their flag's stage: those far above the stage's median."""
    rows = tables.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return quantiles.skewed_rows(rows, "l_extendedprice", 1.9, ["l_returnflag"]).drop("l_returnflag")
