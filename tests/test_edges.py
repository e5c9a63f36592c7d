"""Blank ids, silent days, overlapping runs, repeated codes, ties, NULL keys."""

from datetime import date, datetime

import pytest
from tabular import rows
from pyspark.sql import functions as F

from tidegate.operators import checkpoints, enrich, logs, runs, trends, validate
from tidegate.schema import CHARGE_SCHEMA
from tidegate.session import shared_root


def charges(spark, ids):
    rows = [(i, None, 100 + n, 0, 0, "usd", None, None, "succeeded", 1704067200 + n, True, False, None, None, None) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, CHARGE_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))


def test_rows_without_an_id_are_left_out_or_kept_on_request(spark):
    df = charges(spark, ["a", "", "a", None, " ", ""])
    assert [r.id for r in enrich.enrich_charges(df).collect()] == ["a"]
    assert sorted(str(r.id) for r in enrich.enrich_charges(df, keep_blank=True).collect()) == ["", " ", "None", "a"]
    assert validate.unkeyed(df, "id").count() == 4


def test_a_repeated_rate_multiplies_nothing(spark):
    df = spark.createDataFrame([(100, "eur"), (100, "gbp")], "amount BIGINT, currency STRING")
    rates = spark.createDataFrame([("eur", 1.1), ("eur", 1.2)], "currency STRING, rate DOUBLE")
    got = enrich.convert_currency(df, rates).select("currency", "amount_converted", "unknown_currency")
    assert rows(got) == [("eur", 1.2, False), ("gbp", None, True)]


def test_a_silent_day_is_a_drop(spark):
    daily = spark.createDataFrame([(date(2024, 1, 1), 100), (date(2024, 1, 3), 100)], "dt DATE, records BIGINT")
    got = trends.volume_drops(daily).orderBy("dt").select("records", "alert").collect()
    assert [tuple(r) for r in got] == [(100, False), (0, True), (100, False)]
    scored = trends.metric_anomalies(daily.withColumnRenamed("records", "value")).orderBy("dt").collect()
    assert [r.value for r in scored] == [100, None, 100]
    assert trends.volume_drops(daily.limit(0)).count() == 0


def test_overlapping_runs_of_a_job_keep_their_own_ends(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    lines = [
        (job, run, at(m), text, n)
        for n, (job, run, m, text) in enumerate(
            [("j", "1", 0, "Starting: x"), ("j", "2", 1, "Starting: x"), ("j", "1", 2, "Completed: x"), ("j", "2", 3, "Failed: x"), (None, None, 4, "Starting: x"), ("j", "1", 5, "Starting: x")]
        )
    ]
    df = spark.createDataFrame(lines, "job_id STRING, run_id STRING, ts TIMESTAMP, message STRING, seq INT")
    got = logs.operation_times(df, ["ts", "seq"]).select("job_id", "run_id", "attempt", "outcome", "duration_ms")
    assert rows(got) == sorted([("j", "1", 1, "completed", 120000), ("j", "2", 1, "failed", 120000), (None, None, 1, "open", None), ("j", "1", 2, "open", None)], key=repr)


def test_attempts_may_end_twice_or_before_they_start(spark):
    at = lambda n: None if n is None else datetime(2024, 1, 1, 0, n)
    told = [(1, "Completed: a"), (2, "Starting: a"), (3, "Failed: a"), (5, "Completed: a"), (6, "Starting: a"), (7, "Starting: a"), (9, "Completed: a"), (4, "other")]
    lines = [("j", "1", at(n), text, 1) for n, text in told] + [("j", "2", at(None), "Starting: a", 1), ("j", "2", at(3), "Completed: a", 2)]
    df = spark.createDataFrame(lines, "job_id STRING, run_id STRING, ts TIMESTAMP, message STRING, seq INT")
    got = logs.operation_times(df, ["ts", "seq"], 3).select("run_id", "attempt", "started_at", "ended_at", "outcome")
    assert rows(got) == sorted(
        [("1", 0, None, at(1), "completed"), ("1", 1, at(2), at(5), "failed"), ("1", 2, at(6), None, "open"), ("1", 3, at(7), at(9), "completed"), ("2", 1, None, at(3), "completed")],
        key=repr,
    )


def test_an_end_state_wins_a_tie(spark):
    same = datetime(2024, 1, 1)
    df = spark.createDataFrame([("j", 1, "running", same), ("j", 1, "failed", same)], "job_id STRING, run_no INT, status STRING, updated_at TIMESTAMP")
    assert runs.latest_run_state(df).first().status == "failed"


def test_runs_without_a_job_are_kept(spark):
    data = [(None, n, datetime(2024, 1, 1, n), datetime(2024, 1, 1, n + 2), "failed") for n in range(4)] + [("a", 9, None, None, "failed")]
    df = spark.createDataFrame(data, "job_id STRING, run_no INT, start_time TIMESTAMP, end_time TIMESTAMP, status STRING")
    assert [(r.job_id, r.failures) for r in runs.failure_streaks(df).collect()] == [(None, 4)]
    assert {r.run_no for r in runs.overlapping_runs(df).collect()} == {1, 2, 3}
    assert runs.duration_regressions(df).count() == 5


def test_null_keys_are_recognised_as_stored(spark):
    source = spark.createDataFrame([(None, 5, 1), ("a", 5, 1), ("b", 6, 1)], "id STRING, created BIGINT, amount BIGINT")
    got = checkpoints.incremental_batch(source, source.where("coalesce(id, '') <> 'b'"), 0, 10, ["id"], ["-created"])
    assert [r.id for r in got.collect()] == ["b"]


def test_the_scratch_folder_leaves_the_settings_alone(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_root(spark) and spark.conf.get("spark.checkpoint.dir", None) == before
    assert spark.range(3).select(F.sum("id")).first()[0] == 3


@pytest.mark.parametrize("name", ["volume_drop_alert", "metric_anomalies"])
def test_all_days_are_counted(spark, name):
    from compare import compare, connect

    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), name, sf) == ""


def test_a_silent_day_is_an_anomaly(spark, tmp_path):
    from __spark_entry__ import queries

    # Nine and ten events in turn; the eighth day is silent.
    counts = [9, 10, 9, 10, 9, 10, 9, 0, 10, 9]
    times = [(datetime(2024, 1, 1 + d, 1, n),) for d, count in enumerate(counts) for n in range(count)]
    spark.createDataFrame(times, "ts TIMESTAMP_NTZ").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = queries()["metric_anomalies"](spark, str(tmp_path)).orderBy("dt").collect()
    assert [r.value for r in got] == counts and [r.anomaly for r in got] == [c == 0 for c in counts]
    assert abs(got[8].trailing_mean - 57 / 7) < 1e-6


def test_a_staged_dataset_follows_its_source(spark, tmp_path):
    from tidegate.session import staged_path

    source, written = str(tmp_path / "t.parquet"), []
    spark.range(3).write.parquet(source)
    stage = lambda: staged_path(spark, "edge", str(tmp_path), written.append)
    first = stage()
    assert stage() == first and len(written) == 1
    spark.range(4).write.mode("overwrite").parquet(source)
    assert stage() != first and len(written) == 2
