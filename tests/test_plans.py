"""Physical plans: what reaches the scan, what is combined before a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from tidegate.operators import customers, dedup, enrich, logs, quality
from tidegate.plans import tables

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_range_is_pushed_into_the_scan(spark):
    text = plan(queries()["src_range_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_quality_report_is_one_scan_of_the_needed_columns(spark):
    text = plan(quality.quality_report(enrich.enrich(tables.charges(spark, SF))))
    assert text.count("FileScan") == 1
    assert "o_orderpriority" not in text


def test_keep_latest_combines_before_the_shuffle(spark):
    text = plan(dedup.keep_latest(tables.charges(spark, SF), ["id"], dedup.CHARGE_ORDER))
    assert "partial_min" in text and "Window" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_refund_risk_ranks_before_the_shuffle(spark):
    text = plan(customers.flag_refund_risk(tables.charges(spark, SF)))
    assert re.search(r"WindowGroupLimit.*Partial", text)


@pytest.mark.parametrize(
    "name",
    ["fx_convert", "chunk_record_counts", "src_page_chain_check", "dedup_flag", "new_customer_flag", "incremental_batch",
     "overlapping_runs", "backfill_gaps", "validate_output", "latest_committed_run"],
)
def test_joins_are_equi_joins(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_salted_counts_spread_a_hot_day(spark):
    df = tables.charges(spark, SF).select((F.col("created") % 9).alias("day"), F.col("customer").alias("key"))
    text = plan(quality.salted_daily(df, "day", "key"))
    keys = [len(k.split(", ")) - 1 for k in re.findall(r"Exchange hashpartitioning\((.*?)\), ENSURE", text)]
    assert keys == [1, 2, 3], "by day at the end, by day and salt before, by day, salt and key first"


def test_pages_shuffle_what_charges_are_derived_from(spark):
    text = plan(tables._charge_pages(spark, SF, 100))
    assert text.count("Exchange hashpartitioning") == 1, "the rows are numbered where they were sorted"
    assert "receipt_email" in text
    assert "receipt_email" not in text.split("Exchange hashpartitioning")[1]


def test_operation_times_sort_and_hold_no_groups(spark, monkeypatch):
    monkeypatch.setattr(logs, "TASK_LINES", 100)
    run, text = (F.col("id") % 700).cast("string"), F.concat(F.lit("Starting: "), (F.col("id") % 3).cast("string"))
    lines = spark.range(2000).select(run.alias("job_id"), run.alias("run_id"), F.timestamp_seconds("id").alias("ts"), text.alias("message"))
    text = plan(logs.operation_times(lines, ["ts"]))
    assert "Aggregate" not in text
    assert re.search(r"hashpartitioning\(job_id\S+ run_id\S+ operation\S+ 20\), REPARTITION_BY_NUM", text), "tasks grow with the lines"
