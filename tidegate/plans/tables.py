"""Charges, pages, runs, request logs and log lines derived from the given tables.

Every mapping is a projection over a whole table; the key arithmetic injects the
NULLs, blanks, negative amounts and copies that the clean tables lack. The same
mappings exist as SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.ordered import ordinal
from tidegate.schema import CHARGE_COLUMNS
from tidegate.session import staged_path, use_utc


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Epoch second of an order, spread over its day.
_CREATED = "unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey * 7919) % 86400"

_SIZED = [
    "o_orderkey AS k",
    "o_custkey AS c",
    "CASE WHEN copy = 1 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS s",
    """CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 51 = 0 THEN NULL
            WHEN o_orderkey % 53 = 0 THEN -CAST(round(o_totalprice * 100) AS BIGINT)
            ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS amount""",
    f"{_CREATED} + copy * 60 AS created",
]


def _charge(of: str = "") -> dict[str, str]:
    """The columns of a charge over those of ``_SIZED``, or over the fields of a struct with ``of`` before their names."""
    return {
        "id": f"CASE WHEN {of}k % 97 = 0 THEN '' ELSE 'ch_' || {of}k END",
        "object": "'charge'",
        "amount": f"{of}amount",
        "amount_captured": f"CASE WHEN {of}s = 'F' THEN {of}amount ELSE 0 END",
        "amount_refunded": f"""CASE WHEN {of}k % 10 = 1 THEN {of}amount WHEN {of}k % 10 = 2 THEN floor({of}amount / 2D)
                    WHEN {of}k % 59 = 0 THEN NULL ELSE 0 END""",
        "currency": f"""CASE WHEN {of}k % 61 = 0 THEN NULL WHEN ({of}k * 13) % 10 < 8 THEN 'usd'
                    WHEN ({of}k * 13) % 10 = 8 THEN 'eur' ELSE 'gbp' END""",
        "customer": f"""CASE WHEN {of}k % 17 = 0 THEN NULL WHEN {of}k % 19 = 0 THEN ''
                    WHEN {of}k % 23 = 0 THEN 'test_customer_' || {of}c ELSE 'cus_' || {of}c END""",
        "description": "'order payment'",
        "status": f"CASE {of}s WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'pending' ELSE 'failed' END",
        "created": f"{of}created",
        "paid": f"{of}s = 'F'",
        "refunded": f"{of}k % 10 = 1",
        "payment_method": "'card'",
        "receipt_email": f"""CASE WHEN {of}k % 29 = 0 THEN NULL WHEN {of}k % 31 = 0 THEN 'qa@TEST.io'
                    WHEN {of}k % 37 = 0 THEN 'u@example.com' ELSE 'user' || {of}c || '@mail.org' END""",
        "receipt_url": "'https://receipts.invalid/'",
    }


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = "explode(CASE WHEN o_orderkey % 41 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    return load(spark, sf_dir, "orders").selectExpr("*", copies).selectExpr(*_SIZED)


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge records from orders; some orders yield a second, later version."""
    columns = _charge()
    return _sized(spark, sf_dir).selectExpr(*[f"{columns[name]} AS {name}" for name in CHARGE_COLUMNS])


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS request_id",
        f"timestamp_seconds({_CREATED}) AS ts",
        "CASE WHEN o_orderkey % 100 < 1 THEN 429 WHEN o_orderkey % 100 < 3 THEN 503 ELSE 200 END AS status",
        "(o_orderkey * 37) % 3000 AS duration_ms",
        "CASE WHEN o_orderkey % 100 < 3 THEN 0 ELSE (o_orderkey * 53) % 101 END AS records",
        "o_orderkey % 20 = 0 AS is_retry",
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 67 <> 0 THEN 'job_' || (o_orderkey % 5) END AS job_id",
        "o_orderkey AS run_no",
        f"timestamp_seconds({_CREATED}) AS start_time",
        f"timestamp_seconds({_CREATED} + 60 + (o_orderkey * 31) % 3600) AS end_time",
        "CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running' ELSE 'failed' END AS status",
        "(o_orderkey * 53) % 10007 AS records",
        f"timestamp_seconds({_CREATED} + 90 * 86400) AS expiry_time",
    )


def charge_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Charges as cursor-paged envelopes: 20 chains, the cursor is the last id of a page.

    ``body`` is the JSON envelope a paged endpoint returns. Written once per application and folder.
    """
    name = f"pages-{page_size}"
    path = staged_path(spark, name, sf_dir, lambda path: _charge_pages(spark, sf_dir, page_size).write.parquet(path))
    return spark.read.parquet(path)


def _charge_pages(spark: SparkSession, sf_dir: str, page_size: int) -> DataFrame:
    # Only what a charge is derived from is shuffled; the records, ten times as wide, are made in the pages.
    columns, fields = ["k", "c", "s", "amount", "created"], _charge("item.")
    rows = _sized(spark, sf_dir).withColumn("chain_id", F.col("created") % 20)
    cursor, status = F.expr(_charge()["id"]), F.expr(_charge()["status"])
    placed = ordinal(rows, ["chain_id"], ["created", cursor, "amount", status])
    place, page = F.col("ordinal") % page_size, F.floor((F.col("ordinal") - 1) / page_size)
    # The last row of a page is also the cursor of the next, its first row tells the page before of more.
    roles = F.array_compact(
        F.array(
            F.struct(page.alias("page_no"), F.lit("data").alias("role")),
            F.when(place == 0, F.struct((page + 1).alias("page_no"), F.lit("cursor").alias("role"))),
            F.when((place == 1) & (page > 0), F.struct((page - 1).alias("page_no"), F.lit("more").alias("role"))),
        )
    )
    parts = placed.select("chain_id", "ordinal", *columns, F.inline(roles))
    role = F.col("role")
    pages = parts.groupBy("chain_id", "page_no").agg(
        F.array_sort(F.collect_list(F.when(role == "data", F.struct("ordinal", *columns)))).alias("items"),
        F.max(F.when(role == "cursor", cursor)).alias("starting_after"),
        F.bool_or(role == "more").alias("has_more"),
    )
    record = ", ".join(f"{fields[name]} AS {name}" for name in CHARGE_COLUMNS)
    data = F.expr(f"transform(items, item -> struct({record}))").alias("data")
    return pages.where(F.size("items") > 0).select(
        "chain_id", "page_no", "starting_after", F.to_json(F.struct(data, "has_more")).alias("body")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event, typed."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.when(F.col("event_id") % 71 != 0, F.col("event_type")).alias("operation"),
        F.round(F.col("value") * 10).cast("bigint").alias("duration_ms"),
        (F.col("user_id") % 8).alias("partition_id"),
    )


def log_text(lines: DataFrame) -> DataFrame:
    """The same lines as JSON text, the way a structured logger writes them."""
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("level"),
        F.lit("tidegate").alias("logger"),
        F.concat(F.lit("done: "), F.col("operation")).alias("message"),
        F.lit("extract").alias("module"),
        F.lit("run").alias("function"),
        F.lit(1).alias("line"),
        F.concat(F.lit("line-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("partition_id"),
        F.col("duration_ms"),
        F.col("operation"),
    )
    return lines.select(F.to_json(record).alias("value"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checkpoint per event type."""
    return load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("checkpoint_key")).agg(
        F.max(F.col("ts").cast("timestamp")).alias("last_ts"), F.count("*").alias("records")
    )
