"""The table mappings of ``tables.py`` as SQL, for comparison in another engine."""

AS_OF = "2002-01-01 00:00:00"

CHARGES = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus,
         CAST(round(o_totalprice * 100) AS BIGINT) AS p,
         CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey * 7919) % 86400 AS first_created,
         unnest(CASE WHEN o_orderkey % 41 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM orders),
sized AS (
  SELECT *, CASE WHEN k % 50 = 0 THEN 0 WHEN k % 51 = 0 THEN NULL WHEN k % 53 = 0 THEN -p ELSE p END AS amount,
         CASE WHEN copy = 1 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS s
  FROM base),
charges AS (
  SELECT CASE WHEN k % 97 = 0 THEN '' ELSE 'ch_' || k END AS id,
         'charge' AS object,
         amount,
         CASE WHEN s = 'F' THEN amount ELSE 0 END AS amount_captured,
         CASE WHEN k % 10 = 1 THEN amount WHEN k % 10 = 2 THEN CAST(floor(amount / 2) AS BIGINT)
              WHEN k % 59 = 0 THEN NULL ELSE 0 END AS amount_refunded,
         CASE WHEN k % 61 = 0 THEN NULL WHEN (k * 13) % 10 < 8 THEN 'usd'
              WHEN (k * 13) % 10 = 8 THEN 'eur' ELSE 'gbp' END AS currency,
         CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN ''
              WHEN k % 23 = 0 THEN 'test_customer_' || c ELSE 'cus_' || c END AS customer,
         'order payment' AS description,
         CASE s WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
         first_created + copy * 60 AS created,
         s = 'F' AS paid,
         k % 10 = 1 AS refunded,
         'card' AS payment_method,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 'qa@TEST.io' WHEN k % 37 = 0 THEN 'u@example.com'
              ELSE 'user' || c || '@mail.org' END AS receipt_email,
         'https://receipts.invalid/' AS receipt_url
  FROM sized)"""

ORDERING = """created DESC NULLS LAST, amount DESC NULLS LAST, status NULLS LAST, customer NULLS LAST,
    receipt_email NULLS LAST, currency NULLS LAST, amount_refunded NULLS LAST,
    amount_captured NULLS FIRST, paid NULLS FIRST, refunded NULLS FIRST"""

LATEST = f"""
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {ORDERING}) AS rn FROM charges) WHERE rn = 1)"""

_ENRICHED = f"""
  SELECT *, make_timestamp(created * 1000000) AS created_timestamp,
         CAST(make_timestamp(created * 1000000) AS DATE) AS dt,
         CAST(hour(make_timestamp(created * 1000000)) AS INTEGER) AS hour,
         amount / 100.0::DOUBLE AS amount_usd,
         amount_captured / 100.0::DOUBLE AS amount_captured_usd,
         amount_refunded / 100.0::DOUBLE AS amount_refunded_usd,
         CASE WHEN amount > 0 THEN amount_refunded / amount ELSE 0.0 END AS refund_rate,
         customer IS NOT NULL AND customer <> '' AS has_customer,
         amount_refunded = amount AS is_fully_refunded,
         CAST(date_diff('day', make_timestamp(created * 1000000), TIMESTAMP '{AS_OF}') AS INTEGER) AS record_age_days,
         CAST((id IS NOT NULL)::INT * 20 + (amount IS NOT NULL)::INT * 20 + (currency IS NOT NULL)::INT * 20
              + (status IS NOT NULL)::INT * 20 + (customer IS NOT NULL)::INT * 20 AS INTEGER) AS completeness_score,
         TIMESTAMP '{AS_OF}' AS processed_at, DATE '{AS_OF[:10]}' AS processing_date
  FROM """

ENRICHED = f"""
enriched AS ({_ENRICHED} latest WHERE trim(id) <> '')"""

ENRICHED_ALL = f"""
enriched AS ({_ENRICHED} charges)"""

PAGES = """
placed AS (
  SELECT *, created % 20 AS chain_id,
         (row_number() OVER (PARTITION BY created % 20 ORDER BY created, id, amount NULLS FIRST, status) - 1) // 100
           AS page_no
  FROM charges),
charge_pages AS (
  SELECT *, page_no < max(page_no) OVER (PARTITION BY chain_id) AS has_more,
         lag(last_id) OVER (PARTITION BY chain_id ORDER BY page_no) AS starting_after
  FROM (SELECT chain_id, page_no, count(*) AS n,
               arg_max(id, (created, id, coalesce(amount, -9e18::BIGINT), status)) AS last_id
        FROM placed GROUP BY ALL))"""

REQUESTS = """
request_log AS (
  SELECT k AS request_id, make_timestamp(created * 1000000) AS ts,
         CASE WHEN k % 100 < 1 THEN 429 WHEN k % 100 < 3 THEN 503 ELSE 200 END AS status,
         (k * 37) % 3000 AS duration_ms,
         CASE WHEN k % 100 < 3 THEN 0 ELSE (k * 53) % 101 END AS records,
         k % 20 = 0 AS is_retry
  FROM (SELECT o_orderkey AS k, CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey * 7919) % 86400 AS created
        FROM orders))"""

RUNS = """
job_runs AS (
  SELECT CASE WHEN k % 67 <> 0 THEN 'job_' || (k % 5) END AS job_id, k AS run_no, make_timestamp(created * 1000000) AS start_time,
         make_timestamp((created + 60 + (k * 31) % 3600) * 1000000) AS end_time,
         CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
         (k * 53) % 10007 AS records,
         make_timestamp((created + 90 * 86400) * 1000000) AS expiry_time
  FROM (SELECT o_orderkey AS k, o_orderstatus,
               CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey * 7919) % 86400 AS created FROM orders))"""

LOG = """
log AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
         CASE WHEN event_id % 71 <> 0 THEN event_type END AS operation, CAST(round(value * 10) AS BIGINT) AS duration_ms, user_id % 8 AS partition_id
  FROM events)"""

CHECKPOINTS = """
checkpoints AS (
  SELECT event_type AS checkpoint_key, max(ts) AS last_ts, count(*) AS records FROM events GROUP BY event_type)"""


def day_text(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
