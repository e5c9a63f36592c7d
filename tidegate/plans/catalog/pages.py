"""Pages, chunks, typed ingest and the paged source."""

from pyspark.sql import functions as F

from tidegate.operators import chunks, pages, validate
from tidegate.plans import tables
from tidegate.plans.catalog import query
from tidegate.plans.oracle import CHARGES, PAGES, day_text, ts_text, with_

_RECORD = "id, amount, currency, customer, status, created, paid"


@query("src_flatten_pages", with_(CHARGES, PAGES) + f"SELECT chain_id, page_no, {_RECORD} FROM placed")
def src_flatten_pages(spark, sf):
    flat = pages.flatten_pages(tables.charge_pages(spark, sf), ["chain_id", "page_no"])
    return flat.select("chain_id", "page_no", *_RECORD.split(", "))


@query(
    "src_page_totals",
    with_(CHARGES, PAGES)
    + """SELECT chain_id, count(*) AS pages, sum(n)::BIGINT AS records, max(page_no) AS last_page
    FROM charge_pages GROUP BY chain_id""",
)
def src_page_totals(spark, sf):
    return pages.page_totals(pages.parse_envelopes(tables.charge_pages(spark, sf)))


@query(
    "src_page_progress",
    with_(CHARGES, PAGES)
    + """SELECT chain_id, page_no, n AS records_in_page,
    (sum(n) OVER (PARTITION BY chain_id ORDER BY page_no))::BIGINT AS total_records FROM charge_pages""",
)
def src_page_progress(spark, sf):
    return pages.page_progress(pages.parse_envelopes(tables.charge_pages(spark, sf)))


def broken_pages(spark, sf):
    """All pages, with three defects: a number that is skipped, an empty page behind the last one, a foreign cursor."""
    chain, page = F.col("chain_id"), F.col("page_no")
    placed = tables.charge_pages(spark, sf)
    empty = placed.where(chain == 11).groupBy("chain_id").agg((F.max("page_no") + 1).alias("page_no")).select(
        "chain_id", "page_no", F.lit(None).cast("string").alias("starting_after"), F.lit('{"data":[],"has_more":true}').alias("body")
    )
    changed = placed.withColumn("starting_after", F.when((chain == 13) & (page == 0), "ch_0").otherwise(F.col("starting_after")))
    return changed.withColumn("page_no", F.when((chain == 7) & (page >= 3), page + 1).otherwise(page)).unionByName(empty)


@query(
    "src_page_chain_check",
    with_(
        CHARGES,
        PAGES,
        """
broken AS (
  SELECT chain_id, CASE WHEN chain_id = 7 AND page_no >= 3 THEN page_no + 1 ELSE page_no END AS page_no, has_more, n, last_id,
         CASE WHEN chain_id = 13 AND page_no = 0 THEN 'ch_0' ELSE starting_after END AS starting_after
  FROM charge_pages
  UNION ALL SELECT 11, max(page_no) + 1, TRUE, 0, NULL, NULL FROM charge_pages WHERE chain_id = 11 HAVING count(*) > 0),
linked AS (
  SELECT b.*, p.page_no IS NOT NULL AS has_previous, p.last_id AS expected, s.page_no IS NOT NULL AS has_next
  FROM broken b LEFT JOIN broken p ON p.chain_id = b.chain_id AND p.page_no = b.page_no - 1
  LEFT JOIN broken s ON s.chain_id = b.chain_id AND s.page_no = b.page_no + 1)""",
    )
    + """SELECT chain_id, page_no, problem FROM (
      SELECT chain_id, page_no, CASE WHEN page_no > 0 AND NOT has_previous THEN 'missing_page'
        WHEN has_more AND n = 0 THEN 'empty_page'
        WHEN starting_after IS DISTINCT FROM expected THEN 'wrong_cursor' END AS problem FROM linked
      UNION ALL SELECT chain_id, page_no, 'open_end' FROM linked WHERE has_more AND NOT has_next)
    WHERE problem IS NOT NULL""",
)
def src_page_chain_check(spark, sf):
    return pages.check_chains(pages.parse_envelopes(broken_pages(spark, sf)))


def _event_bounds(spark, sf):
    """First event and the end of the range, just after the last one, as scalar subqueries; nothing is collected."""
    ts = tables.load(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    # Chunks are half-open: an end at the last event itself would leave it out.
    end = F.timestamp_micros(F.unix_micros(F.max("ts")) + 1)
    return ts, ts.select(F.min("ts")).scalar(), ts.select(end).scalar()


CHUNKS = """
chunks AS (
  SELECT row_number() OVER (ORDER BY s) - 1 AS chunk_no, s AS start_ts, least(s + INTERVAL {h} HOUR, hi) AS end_ts
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL {h} HOUR)) AS s, hi
        FROM (SELECT min(ts) AS lo, max(ts) + INTERVAL 1 MICROSECOND AS hi FROM events)) WHERE s < hi)"""
CHUNKS_DAY, CHUNKS_HOUR = CHUNKS.format(h=24), CHUNKS.format(h=1)
COUNTED = """
counted AS (
  SELECT c.*, coalesce(n, 0) AS records FROM chunks c LEFT JOIN (
    SELECT (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) // ({h} * 3600000000) AS chunk_no, count(*) AS n
    FROM events GROUP BY 1) USING (chunk_no))"""
COUNTED_DAY, COUNTED_HOUR = COUNTED.format(h=24), COUNTED.format(h=1)


def event_chunks(spark, sf, hours=24):
    """Counted chunks over the whole event range."""
    ts, lo, hi = _event_bounds(spark, sf)
    plan = chunks.plan_chunks(spark, lo, hi, hours)
    return chunks.chunk_counts(ts, "ts", plan, lo, hi, hours)


@query(
    "chunk_plan",
    with_(CHUNKS_DAY) + f"SELECT chunk_no, {ts_text('start_ts')} AS start_ts, {ts_text('end_ts')} AS end_ts FROM chunks",
)
def chunk_plan(spark, sf):
    _, lo, hi = _event_bounds(spark, sf)
    return chunks.plan_chunks(spark, lo, hi)


@query(
    "chunk_plan_balanced",
    with_(
        CHUNKS_HOUR,
        COUNTED_HOUR,
        """
pieces AS (
  SELECT chunk_no, start_ts, end_ts, records, greatest(1, ceil(records / 12))::BIGINT AS k,
         unnest(range(greatest(1, ceil(records / 12))::BIGINT)) AS i FROM counted),
cut AS (
  SELECT chunk_no, i, epoch_us(start_ts) + (epoch_us(end_ts) - epoch_us(start_ts)) * i // k AS lo,
         epoch_us(start_ts) + (epoch_us(end_ts) - epoch_us(start_ts)) * (i + 1) // k AS hi, records / k AS weight
  FROM pieces),
grouped AS (
  SELECT *, CAST(floor(coalesce(sum(weight) OVER (ORDER BY chunk_no, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    / 12 + 1e-9) AS BIGINT) AS g FROM cut)""",
    )
    + f"""SELECT g AS group_no, {ts_text('make_timestamp(min(lo))')} AS start_ts,
    {ts_text('make_timestamp(max(hi))')} AS end_ts, round(sum(weight), 6) AS expected FROM grouped GROUP BY g""",
)
def chunk_plan_balanced(spark, sf):
    return chunks.balance_chunks(event_chunks(spark, sf, 1), 12)


@query(
    "chunk_record_counts",
    with_(CHUNKS_HOUR, COUNTED_HOUR)
    + f"""SELECT chunk_no, {ts_text('start_ts')} AS start_ts, {ts_text('end_ts')} AS end_ts, records FROM counted""",
)
def chunk_record_counts(spark, sf):
    return event_chunks(spark, sf, 1)


@query(
    "chunk_skew",
    with_(CHUNKS_HOUR, COUNTED_HOUR)
    + f"""SELECT chunk_no, {ts_text('start_ts')} AS start_ts, {ts_text('end_ts')} AS end_ts, records,
    round(m, 6) AS median FROM counted, (SELECT median(records) AS m FROM counted) WHERE records > 1.1 * m""",
)
def chunk_skew(spark, sf):
    """The events are spread evenly, so the factor is low enough to report something."""
    return chunks.skewed_chunks(event_chunks(spark, sf, 1), factor=1.1)


@query(
    "src_range_filter",
    f"""SELECT event_id, {ts_text('ts')} AS ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'""",
)
def src_range_filter(spark, sf):
    lo, hi = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-08", "2024-01-22"))
    rows = tables.load(spark, sf, "events").where(chunks.in_range(F.col("ts"), lo, hi))
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"))


def charge_json(spark, sf):
    """Charges as JSON text with a key the schema does not know; NULLs are left out."""
    columns = F.struct("*", F.lit(False).alias("livemode"))
    return tables.charges(spark, sf).select(F.to_json(columns).alias("value"))


@query("src_typed_ingest", with_(CHARGES) + "SELECT * FROM charges")
def src_typed_ingest(spark, sf):
    return validate.typed_ingest(charge_json(spark, sf))


def damaged_json(spark, sf):
    """Charge JSON where some texts are cut short and some amounts are words or quoted numbers."""
    n = F.col("created")
    return charge_json(spark, sf).withColumn("created", F.get_json_object("value", "$.created").cast("bigint")).select(
        F.when(n % 101 == 0, F.substring("value", 1, 40))
        .when(n % 103 == 0, F.regexp_replace("value", '"amount":-?\\d+', '"amount":"many"'))
        .when(n % 107 == 0, F.regexp_replace("value", '"amount":(-?\\d+)', '"amount":"$1"'))
        .otherwise(F.col("value"))
        .alias("value")
    )


_DAMAGED = """
damaged AS (
  SELECT *, created % 101 = 0 AS cut, created % 101 <> 0 AND (created % 103 = 0 OR created % 107 = 0) AND amount IS NOT NULL AS word
  FROM charges)"""


@query(
    "schema_validate",
    with_(CHARGES, _DAMAGED)
    + "SELECT id, amount, currency, customer, status, created, paid FROM damaged WHERE NOT cut AND NOT word AND id <> ''",
)
def schema_validate(spark, sf):
    return validate.valid_rows(validate.validate_schema(damaged_json(spark, sf))).select(*_RECORD.split(", "))


@query(
    "schema_rejects",
    with_(CHARGES, _DAMAGED)
    + """SELECT reasons, count(*) AS records FROM (
      SELECT CASE WHEN cut THEN 'malformed' ELSE concat_ws(',', CASE WHEN id = '' THEN 'missing:id' END,
        CASE WHEN word THEN 'type:amount' END) END AS reasons FROM damaged) WHERE reasons <> '' GROUP BY reasons""",
)
def schema_rejects(spark, sf):
    rejected = validate.rejected_rows(validate.validate_schema(damaged_json(spark, sf)))
    return rejected.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("records"))


@query(
    "multi_source_union",
    with_(CHARGES)
    + f"""SELECT 'payments' AS source, id AS key, {day_text('make_timestamp(created * 1000000)')} AS dt,
      round(amount / 100.0::DOUBLE, 6) AS value, currency FROM charges
    UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), {day_text('ts')}, round(value, 6), NULL FROM events""",
)
def multi_source_union(spark, sf):
    charges = validate.conform(
        tables.charges(spark, sf),
        {
            "key": F.col("id"),
            "dt": F.to_date(F.timestamp_seconds("created")),
            "value": F.col("amount") / 100.0,
            "currency": F.col("currency"),
        },
        "payments",
    )
    events = validate.conform(
        tables.load(spark, sf, "events"),
        {"key": F.col("event_id").cast("string"), "dt": F.to_date("ts"), "value": F.col("value")},
        "events",
    )
    return validate.union_sources(charges, events)


@query(
    "chunk_forecast",
    with_(
        """
means AS (
  SELECT h AS hour_of_day, coalesce(n, 0) / 20::DOUBLE AS records FROM (SELECT unnest(range(24)) AS h)
  LEFT JOIN (SELECT hour(ts) AS h, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1) USING (h))"""
    )
    + f"""SELECT row_number() OVER (ORDER BY s) - 1 AS chunk_no, {ts_text('s')} AS start_ts, {ts_text('s + INTERVAL 1 HOUR')} AS end_ts, round(records, 6) AS records
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-21', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS s) JOIN means ON hour(s) = hour_of_day""",
)
def chunk_forecast(spark, sf):
    """Records to expect in each hour of the last ten days, from those of the twenty days before."""
    seen = tables.load(spark, sf, "events").where(chunks.in_range(F.col("ts"), F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-21").cast("timestamp_ntz")))
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600) * 3600
    history = seen.groupBy(hour.alias("hour_s")).agg(F.count("*").alias("records"))
    covered = chunks.plan_chunks(spark, "2024-01-01", "2024-01-21", 1).select(F.unix_seconds("start_ts").alias("hour_s"))
    return chunks.forecast_counts(history, covered, chunks.plan_chunks(spark, "2024-01-21", "2024-01-31", 1))
