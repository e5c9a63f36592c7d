"""Scalar columns, filters, aggregates and window-like flags over charges."""

from pyspark.sql import functions as F

from tidegate.functions import scores, text, times
from tidegate.operators import customers, dedup, enrich, filters, quality, sketches, trends, validate
from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.oracle import (
    AS_OF,
    CHARGES,
    ENRICHED,
    ENRICHED_ALL,
    LATEST,
    ORDERING,
    RUNS,
    day_text,
    ts_text,
    with_,
)


def as_of():
    return times.as_timestamp(AS_OF)


def enriched(spark, sf):
    """Every charge row with its derived columns, copies included."""
    return enrich.enrich(tables.charges(spark, sf), as_of())


def enriched_latest(spark, sf):
    return enrich.enrich_charges(tables.charges(spark, sf), as_of())


_ALL = with_(CHARGES, ENRICHED_ALL)
_LATEST = with_(CHARGES, LATEST, ENRICHED)
_ENRICHED_OUT = f"""
  * EXCLUDE (created_timestamp, dt, amount_usd, amount_captured_usd, amount_refunded_usd, refund_rate,
             processed_at, processing_date),
  {ts_text('created_timestamp')} AS created_timestamp, {day_text('dt')} AS dt,
  round(amount_usd, 6) AS amount_usd, round(amount_captured_usd, 6) AS amount_captured_usd,
  round(amount_refunded_usd, 6) AS amount_refunded_usd, round(refund_rate, 6) AS refund_rate,
  {ts_text('processed_at')} AS processed_at, {day_text('processing_date')} AS processing_date"""


@query("enrich_charges", _LATEST + f"SELECT {_ENRICHED_OUT} FROM enriched")
def enrich_charges(spark, sf):
    return enriched_latest(spark, sf)


@query("refund_rate", _ALL + "SELECT id, created, amount, amount_refunded, round(refund_rate, 6) AS refund_rate FROM enriched")
def refund_rate(spark, sf):
    return enriched(spark, sf).select("id", "created", "amount", "amount_refunded", "refund_rate")


@query("quality_flags", _ALL + "SELECT id, created, customer, has_customer, is_fully_refunded FROM enriched")
def quality_flags(spark, sf):
    return enriched(spark, sf).select("id", "created", "customer", "has_customer", "is_fully_refunded")


@query("record_age", _ALL + "SELECT id, created, record_age_days FROM enriched")
def record_age(spark, sf):
    return enriched(spark, sf).select("id", "created", "record_age_days")


@query("completeness_score", _ALL + "SELECT id, created, completeness_score FROM enriched")
def completeness_score(spark, sf):
    return enriched(spark, sf).select("id", "created", "completeness_score")


@query(
    "processing_metadata",
    with_(CHARGES)
    + f"""SELECT id, created, {ts_text(f"TIMESTAMP '{AS_OF}'")} AS processed_at, '{AS_OF[:10]}' AS processing_date,
    'job-1' AS job_id, 'payments_api' AS data_source FROM charges""",
)
def processing_metadata(spark, sf):
    rows = tables.charges(spark, sf).select("id", "created")
    return enrich.add_processing_metadata(rows, "job-1", "payments_api", as_of())


@query(
    "date_partitions",
    with_(CHARGES)
    + f"""SELECT id, created, {ts_text('t')} AS created_timestamp, {day_text('t')} AS dt,
    CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
    CAST(hour(t) AS INTEGER) AS hour
    FROM (SELECT id, created, make_timestamp(created * 1000000) AS t FROM charges)""",
)
def date_partitions(spark, sf):
    rows = tables.charges(spark, sf).select(
        "id", "created", times.created_timestamp(F.col("created")).alias("created_timestamp")
    )
    return enrich.add_date_partitions(rows)


@query(
    "monetary_metrics",
    with_(CHARGES)
    + """SELECT id, created, currency, amount, round(amount / 100.0::DOUBLE, 6) AS amount_usd,
    amount_refunded, round(amount_refunded / 100.0::DOUBLE, 6) AS amount_refunded_usd FROM charges""",
)
def monetary_metrics(spark, sf):
    rows = tables.charges(spark, sf).select("id", "created", "currency", "amount", "amount_refunded")
    return rows.transform(enrich.add_amount_usd).transform(enrich.add_amount_usd, "amount_refunded")


@query(
    "fx_convert",
    with_(CHARGES)
    + """SELECT id, created, currency, amount, r.rate,
    round((amount / 100.0::DOUBLE) * r.rate, 6) AS amount_converted, r.rate IS NULL AS unknown_currency
    FROM charges LEFT JOIN (VALUES ('usd', 1.0::DOUBLE), ('eur', 1.1::DOUBLE)) r(code, rate) ON currency = code""",
)
def fx_convert(spark, sf):
    rows = tables.charges(spark, sf).select("id", "created", "currency", "amount")
    return enrich.convert_currency(rows, {"usd": 1.0, "eur": 1.1})


@query(
    "quality_score",
    with_(CHARGES)
    + """SELECT id, created, CAST((id <> '')::INT * 33 + (amount IS NOT NULL)::INT * 33
    + (customer IS NOT NULL AND customer <> '')::INT * 33 AS INTEGER) AS quality_score FROM charges""",
)
def quality_score(spark, sf):
    rows = enrich.add_quality_score(tables.charges(spark, sf), ["id", "amount", "customer"])
    return rows.select("id", "created", "quality_score")


def _weighted(rows):
    return scores.weighted_quality_score(
        rows,
        ["id", "amount", "currency", "status", "customer"],
        ["receipt_email", "description"],
        [F.col("amount") >= 0, F.col("amount_refunded") <= F.col("amount")],
    )


@query(
    "weighted_quality_score",
    with_(CHARGES)
    + """SELECT id, created, round(
      ((id <> '')::INT + (amount IS NOT NULL)::INT + (currency IS NOT NULL)::INT + (status IS NOT NULL)::INT
       + (customer IS NOT NULL AND customer <> '')::INT) / 5.0::DOUBLE * 50
      + ((receipt_email IS NOT NULL)::INT + 1) / 2.0::DOUBLE * 30
      + (coalesce(amount >= 0, FALSE)::INT + coalesce(amount_refunded <= amount, FALSE)::INT) / 2.0::DOUBLE * 20, 6)
      AS weighted_score FROM charges""",
)
def weighted_quality_score(spark, sf):
    rows = tables.charges(spark, sf)
    return rows.select("id", "created", _weighted(rows).alias("weighted_score"))


@query(
    "business_flags",
    _ALL
    + """SELECT id, created, amount_usd > 1000 AS is_high_value, status = 'failed' AS is_failed,
    is_fully_refunded, currency <> 'usd' AS is_international FROM enriched""",
)
def business_flags(spark, sf):
    rows = enrich.add_business_flags(enriched(spark, sf))
    return rows.select("id", "created", "is_high_value", "is_failed", "is_fully_refunded", "is_international")


@query(
    "validity_flags",
    with_(CHARGES)
    + f"""SELECT id, created, amount < 0 AS is_negative,
    make_timestamp(created * 1000000) < TIMESTAMP '{AS_OF}' - INTERVAL 2 YEAR AS is_stale FROM charges""",
)
def validity_flags(spark, sf):
    rows = enrich.add_validity_flags(tables.charges(spark, sf), as_of())
    return rows.select("id", "created", "is_negative", "is_stale")


@query(
    "consistency_rules",
    with_(CHARGES)
    + """SELECT id, created, concat_ws(',',
      CASE WHEN amount_captured > amount THEN 'captured_exceeds_amount' END,
      CASE WHEN amount_refunded > amount_captured THEN 'refund_exceeds_captured' END,
      CASE WHEN refunded <> (amount_refunded = amount AND amount > 0) THEN 'refunded_flag_mismatch' END,
      CASE WHEN paid <> (status = 'succeeded') THEN 'paid_status_mismatch' END) AS violations FROM charges""",
)
def consistency_rules(spark, sf):
    return enrich.add_consistency(tables.charges(spark, sf)).select("id", "created", "violations")


_TEST = """(coalesce(contains(lower(receipt_email), 'test') OR contains(lower(receipt_email), 'example.com')
    OR contains(lower(receipt_email), 'test_'), {null}) OR coalesce(starts_with(customer, 'test_'), {null}))"""
_TEST_KEEP, _TEST_DROP = _TEST.format(null="FALSE"), _TEST.format(null="TRUE")
_ROW = "id, created, amount, receipt_email, customer"


@query("test_data_flag", with_(CHARGES) + f"SELECT {_ROW}, {_TEST_KEEP} AS is_test_data FROM charges")
def test_data_flag(spark, sf):
    return filters.flag_test_rows(tables.charges(spark, sf)).select(*_ROW.split(", "), "is_test_data")


@query("filter_test_data", with_(CHARGES) + f"SELECT {_ROW} FROM charges WHERE NOT {_TEST_KEEP}")
def filter_test_data(spark, sf):
    return filters.drop_test_rows(tables.charges(spark, sf)).select(*_ROW.split(", "))


@query("filter_test_data_compat", with_(CHARGES) + f"SELECT {_ROW} FROM charges WHERE NOT {_TEST_DROP}")
def filter_test_data_compat(spark, sf):
    return filters.drop_test_rows(tables.charges(spark, sf), null_is_test=True).select(*_ROW.split(", "))


@query(
    "test_data_stats",
    with_(CHARGES)
    + f"""SELECT count(*) AS initial_count, count(*) FILTER ({_TEST_DROP}) AS test_records,
    round(count(*) FILTER ({_TEST_DROP}) / count(*), 6) AS test_rate FROM charges""",
)
def test_data_stats(spark, sf):
    return filters.test_row_stats(tables.charges(spark, sf), null_is_test=True)


@query("filter_test_amounts", with_(CHARGES) + f"SELECT {_ROW} FROM charges WHERE amount IS NULL OR amount NOT IN (100, 1)")
def filter_test_amounts(spark, sf):
    return filters.drop_test_amounts(tables.charges(spark, sf)).select(*_ROW.split(", "))


@query("low_completeness_rows", _ALL + "SELECT id, created, completeness_score FROM enriched WHERE completeness_score < 80")
def low_completeness_rows(spark, sf):
    return filters.low_completeness(enriched(spark, sf)).select("id", "created", "completeness_score")


@query(
    "quality_quarantine",
    _ALL
    + """SELECT id, created, completeness_score,
    CASE WHEN completeness_score >= 70 THEN 'pass' ELSE 'quarantine' END AS disposition FROM enriched""",
)
def quality_quarantine(spark, sf):
    rows = filters.quarantine(enriched(spark, sf), F.col("completeness_score"))
    return rows.select("id", "created", "completeness_score", "disposition")


@query(
    "mask_sensitive",
    """SELECT c_custkey, CASE WHEN length(c_name) > 4 THEN left(c_name, 4) || '****' ELSE '****' END AS c_name,
    CASE WHEN length(c_mktsegment) > 9 THEN left(c_mktsegment, 9) || '****' ELSE '****' END AS c_mktsegment
    FROM customer""",
)
def mask_sensitive(spark, sf):
    rows = tables.load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return rows.transform(enrich.mask_columns, ["c_name"]).transform(enrich.mask_columns, ["c_mktsegment"], 9)


@query(
    "iso_timestamps",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, {ts_text("date_trunc('second', ts)")} AS parsed
    FROM events""",
)
def iso_timestamps(spark, sf):
    rows = tables.load(spark, sf, "events").select("event_id", times.to_iso(F.col("ts").cast("timestamp")).alias("iso"))
    return rows.withColumn("parsed", times.from_iso(F.col("iso")))


@query(
    "metadata_json",
    with_(CHARGES, LATEST, ENRICHED)
    + f"""SELECT {day_text('dt')} AS dt, count(*) AS total_records,
    count(*) FILTER (has_customer) AS records_with_customer FROM enriched GROUP BY dt""",
)
def metadata_json(spark, sf):
    """Daily metrics to JSON text and back, as stored in a checkpoint."""
    daily = enriched_latest(spark, sf).groupBy("dt").agg(
        F.count("*").alias("total_records"), F.count_if("has_customer").alias("records_with_customer")
    )
    stored = daily.select("dt", F.to_json(F.struct("total_records", "records_with_customer")).alias("metadata"))
    parsed = F.from_json("metadata", "total_records BIGINT, records_with_customer BIGINT").alias("m")
    return stored.select("dt", parsed).select("dt", "m.*")


def run_id_column():
    stamp = F.date_format("start_time", "yyyyMMdd-HHmmss")
    return F.concat(F.lit("run-"), stamp, F.lit("-"), F.lpad(F.lower(F.hex("run_no")), 8, "0"))


RUN_ID_SQL = "'run-' || strftime(start_time, '%Y%m%d-%H%M%S') || '-' || format('{:08x}', run_no)"


@query(
    "run_id_parse",
    with_(RUNS)
    + f"""SELECT {RUN_ID_SQL} AS run_id, {ts_text('start_time')} AS started_at,
    format('{{:08x}}', run_no) AS suffix FROM job_runs""",
)
def run_id_parse(spark, sf):
    runs = tables.job_runs(spark, sf).select(run_id_column().alias("run_id"))
    return runs.select(
        "run_id", text.run_started_at(F.col("run_id")).alias("started_at"), text.run_suffix(F.col("run_id")).alias("suffix")
    )


@query(
    "enrich_composed",
    with_(CHARGES, LATEST, ENRICHED)
    + f"""SELECT id, created, {day_text('dt')} AS dt, CAST(year(dt) AS INTEGER) AS year, round(amount_usd, 6) AS amount_usd,
    amount_usd > 1000 AS is_high_value,
    CAST((id <> '')::INT * 50 + (customer IS NOT NULL AND customer <> '')::INT * 50 AS INTEGER) AS quality_score,
    'job-1' AS job_id FROM enriched WHERE NOT {_TEST_KEEP}""",
)
def enrich_composed(spark, sf):
    """Several operators chained into one."""
    steps = enrich.compose(
        filters.drop_test_rows,
        lambda df: validate.keyed(df, "id"),
        lambda df: dedup.keep_latest(df, ["id"], dedup.CHARGE_ORDER),
        lambda df: df.withColumn("created_timestamp", times.created_timestamp(F.col("created"))),
        enrich.add_date_partitions,
        enrich.add_amount_usd,
        lambda df: enrich.add_processing_metadata(df, "job-1", "payments_api", as_of()),
        lambda df: enrich.add_quality_score(df, ["id", "customer"]),
        enrich.add_business_flags,
    )
    return steps(tables.charges(spark, sf)).select(
        "id", "created", "dt", "year", "amount_usd", "is_high_value", "quality_score", "job_id"
    )


_METRICS = """count(*) AS total_records, count(*) FILTER (has_customer) AS records_with_customer,
  count(*) FILTER (is_fully_refunded) AS fully_refunded_count,
  count(*) FILTER (completeness_score < 80) AS low_completeness_count, CAST(80 AS BIGINT) AS completeness_threshold,
  round(avg(completeness_score), 6) AS avg_completeness_score, round(min(amount_usd), 6) AS min_amount,
  round(max(amount_usd), 6) AS max_amount, round(avg(amount) / 100, 6) AS avg_amount"""
_VERDICT = """CASE WHEN count(*) = 0 THEN 'FAILED'
  WHEN count(*) FILTER (completeness_score < 80) / count(*) > 0.20 THEN 'FAILED'
  WHEN count(*) FILTER (completeness_score < 80) / count(*) > 0.05 THEN 'WARNING' ELSE 'PASSED' END AS quality_check"""
_RATE = "round(count(*) FILTER (completeness_score < 80) / count(*), 6) AS low_quality_rate"


@query("quality_metrics", _LATEST + f"SELECT {_METRICS} FROM enriched")
def quality_metrics(spark, sf):
    return quality.quality_metrics(enriched_latest(spark, sf))


@query("quality_verdict", _LATEST + f"SELECT {_METRICS}, {_RATE}, {_VERDICT} FROM enriched")
def quality_verdict(spark, sf):
    return quality.quality_report(enriched_latest(spark, sf))


@query("quality_empty_input", _LATEST + f"SELECT {_METRICS}, {_RATE.replace('/ count(*)', '/ nullif(count(*), 0)')}, {_VERDICT} FROM enriched WHERE created < 0")
def quality_empty_input(spark, sf):
    """The report over no rows: one row, and the verdict stops the run."""
    return quality.quality_report(enriched_latest(spark, sf).where("created < 0"))


DAILY_QUALITY_SQL = (
    _LATEST + f"SELECT {day_text('dt')} AS dt, {_METRICS}, {_RATE}, {_VERDICT} FROM enriched GROUP BY dt"
)


@query("daily_quality_trend", DAILY_QUALITY_SQL)
def daily_quality_trend(spark, sf):
    return quality.quality_report(enriched_latest(spark, sf), by=["dt"])


@query(
    "duplicate_stats",
    with_(CHARGES)
    + """SELECT count(*) AS initial_count, count(DISTINCT id) AS final_count,
    count(*) - count(DISTINCT id) AS duplicates_removed,
    round((count(*) - count(DISTINCT id)) / count(*), 6) AS duplicate_rate FROM charges""",
)
def duplicate_stats(spark, sf):
    return dedup.duplicate_stats(tables.charges(spark, sf), ["id"])


@query(
    "duplicate_stats_lineitem",
    """SELECT sum(n)::BIGINT AS initial_count, count(*) AS final_count, (sum(n) - count(*))::BIGINT AS duplicates_removed,
    round((sum(n) - count(*)) / sum(n), 6) AS duplicate_rate
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def duplicate_stats_lineitem(spark, sf):
    return dedup.duplicate_stats(tables.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, sf):
    return dedup.distinct_keys(tables.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedup_keep_latest", with_(CHARGES, LATEST) + "SELECT * FROM latest")
def dedup_keep_latest(spark, sf):
    return dedup.keep_latest(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    "dedup_keep_latest_lineitem",
    f"""SELECT {_LINE}, {ts_text('l_shipdate')} AS l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_keep_latest_lineitem(spark, sf):
    rows = tables.load(spark, sf, "lineitem").select(*_LINE.split(", "), F.col("l_shipdate").cast("timestamp"))
    order = ["-l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return dedup.keep_latest(rows, ["l_orderkey", "l_linenumber"], order)


@query(
    "dedup_flag",
    with_(CHARGES)
    + f"""SELECT id, created, amount, status,
    row_number() OVER (PARTITION BY id ORDER BY {ORDERING}) > 1 AS is_duplicate FROM charges""",
)
def dedup_flag(spark, sf):
    flagged = dedup.flag_duplicates(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)
    return flagged.select("id", "created", "amount", "status", "is_duplicate")


@query(
    "new_customer_flag",
    with_(CHARGES, LATEST)
    + """SELECT id, created, customer, customer IS NOT NULL AND row_number() OVER (PARTITION BY customer
      ORDER BY created, id) = 1 AS is_new_customer FROM latest""",
)
def new_customer_flag(spark, sf):
    rows = dedup.keep_latest(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)
    return customers.flag_new_customers(rows.select("id", "created", "customer"))


@query(
    "refund_risk_flag",
    with_(CHARGES, LATEST)
    + """SELECT id, created, customer, status, customer IS NOT NULL AND count(*) FILTER (status = 'failed') OVER (
      PARTITION BY customer ORDER BY created, id ROWS UNBOUNDED PRECEDING) >= 2 AS is_refund_risk FROM latest""",
)
def refund_risk_flag(spark, sf):
    rows = dedup.keep_latest(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)
    return customers.flag_refund_risk(rows.select("id", "created", "customer", "status"))


@query(
    "volume_rollup",
    _LATEST
    + f"""SELECT {day_text('dt')} AS dt, currency, CAST(grouping(dt, currency) AS INTEGER) AS level,
    count(*) AS records, round(sum(amount)::DOUBLE / 100, 2) AS total_usd FROM enriched GROUP BY ROLLUP (dt, currency)""",
)
def volume_rollup(spark, sf):
    return trends.volume_rollup(enriched_latest(spark, sf))


@query(
    "volume_drop_alert",
    _LATEST
    + f"""SELECT {day_text('dt')} AS dt, records, previous, coalesce(records < 0.5 * previous, FALSE) AS alert
    FROM (SELECT dt, coalesce(n, 0) AS records, lag(coalesce(n, 0)) OVER (ORDER BY dt) AS previous
      FROM (SELECT CAST(unnest(generate_series(min(dt)::TIMESTAMP, max(dt)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS dt
            FROM enriched)
      LEFT JOIN (SELECT dt, count(*) AS n FROM enriched GROUP BY dt) USING (dt))""",
)
def volume_drop_alert(spark, sf):
    """Every day counts."""
    daily = enriched_latest(spark, sf).groupBy("dt").agg(F.count("*").alias("records"))
    return trends.volume_drops(daily)


_CHECKED = ["id", "amount", "amount_refunded", "currency", "customer", "status", "receipt_email", "created"]


@query(
    "column_completeness",
    with_(CHARGES)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total, count(*) FILTER ({c} IS NULL) AS nulls,
        count(*) FILTER ({c}::VARCHAR = '') AS blanks, round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_share,
        round(count(*) FILTER ({c} IS NULL OR {c}::VARCHAR = '') / count(*), 6) AS missing_share FROM charges"""
        for c in _CHECKED
    ),
)
def column_completeness(spark, sf):
    return quality.column_completeness(tables.charges(spark, sf), _CHECKED)


@query(
    "metrics_rollforward",
    with_(CHARGES, LATEST)
    + """SELECT currency, count(*) AS records, round(sum(amount)::DOUBLE / 100, 2) AS total_usd,
    round(sum(amount)::DOUBLE / count(amount) / 100, 6) AS avg_usd, min(amount) AS value_min, max(amount) AS value_max
    FROM latest GROUP BY currency""",
)
def metrics_rollforward(spark, sf):
    """Partial metrics per monthly run, merged without the rows."""
    rows = dedup.keep_latest(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)
    runs = rows.withColumn("run", F.date_format(times.created_timestamp(F.col("created")), "yyyy-MM"))
    return quality.merge_metrics(quality.partial_metrics(runs, ["run", "currency"]), ["currency"])


@query(
    "salted_daily_agg",
    with_(CHARGES)
    + f"""SELECT {day_text('make_timestamp(created * 1000000)')} AS dt, count(*) AS records,
    count(DISTINCT customer) AS distinct_keys FROM charges GROUP BY 1""",
)
def salted_daily_agg(spark, sf):
    rows = tables.charges(spark, sf).select(
        "customer", F.to_date(times.created_timestamp(F.col("created"))).alias("dt")
    )
    return quality.salted_daily(rows, "dt", "customer")


@query(
    "quality_alert",
    _LATEST
    + f"""SELECT {day_text('dt')} AS dt, count(*) AS records, round(avg(completeness_score), 6) AS avg_score,
    avg(completeness_score) < 90 AS alert FROM enriched GROUP BY dt""",
)
def quality_alert(spark, sf):
    return quality.quality_alert(enriched_latest(spark, sf), "completeness_score", ["dt"])


@query(
    "metric_anomalies",
    f"""SELECT {day_text('dt')} AS dt, round(value, 6) AS value, round(m, 6) AS trailing_mean, round(sd, 6) AS trailing_stddev,
    round((value - m) / nullif(sd, 0), 6) AS z_score, coalesce(abs((value - m) / nullif(sd, 0)) > 2, FALSE) AS anomaly
    FROM (SELECT dt, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
          FROM (SELECT dt, coalesce(n, 0)::DOUBLE AS value
                FROM (SELECT CAST(unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS dt FROM events)
                LEFT JOIN (SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1) USING (dt))
          WINDOW w AS (ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
)
def metric_anomalies(spark, sf):
    """Daily counts of the events, scored on every day."""
    rows = tables.load(spark, sf, "events")
    daily = rows.groupBy(F.to_date("ts").alias("dt")).agg(
        F.count("*").cast("double").alias("value")
    )
    return trends.metric_anomalies(daily, limit=2.0, fill=0.0)


@query(
    "sketch_rollforward",
    with_(CHARGES, LATEST) + "SELECT currency, count(*) AS records, TRUE AS distinct_within, TRUE AS median_within FROM latest GROUP BY currency",
)
def sketch_rollforward(spark, sf):
    """Sketches of monthly runs, merged without the rows, against the exact figures: four standard errors of each."""
    rows = dedup.keep_latest(tables.charges(spark, sf), ["id"], dedup.CHARGE_ORDER)
    runs = rows.withColumn("run", F.date_format(times.created_timestamp(F.col("created")), "yyyy-MM"))
    merged = sketches.merge_sketches(sketches.partial_sketches(runs, ["run", "currency"], "customer", "amount"), ["currency"])
    found = merged.select(F.col("currency").alias("of"), "records", "distinct_keys", "quantile")
    exact = rows.join(found, F.col("currency").eqNullSafe(F.col("of"))).groupBy("currency", "records").agg(
        F.countDistinct("customer").alias("keys"),
        F.first("distinct_keys").alias("distinct_keys"),
        F.avg((F.col("amount") < F.col("quantile")).cast("int")).alias("below"),
        F.avg((F.col("amount") <= F.col("quantile")).cast("int")).alias("upto"),
    )
    near = F.abs(F.col("distinct_keys") - F.col("keys")) <= F.ceil(F.col("keys") * 4 * 0.0082)
    return exact.select("currency", "records", near.alias("distinct_within"), ((F.col("below") <= 0.504) & (F.col("upto") >= 0.496)).alias("median_within"))
