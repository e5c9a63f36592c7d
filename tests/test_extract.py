"""The whole job against pages that Spark landed from a small charge table."""

import json
import os
from datetime import datetime, timedelta, timezone

import landed
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidegate.operators.checkpoints import fold_checkpoints, resume_point, resume_points, safe_high_water_mark
from tidegate.plans.extract import ExtractConfig, current_charges, read_checkpoints, read_runs, reset_checkpoint, run_extract
from tidegate.schema import RUN_SCHEMA
from tidegate.sources import paged

DAY = 86400
START = 1704067200  # 2024-01-01
KEY = "charges"


def land(spark, path, days, customers=True, version=0):
    """Two pages of two charges per day, the last one repeated from the day before."""
    pages = []
    for day in range(days):
        base = START + day * DAY
        charge = lambda n, at: {
            "id": f"ch_{n}", "amount": 100 + version, "currency": "usd" if customers else None,
            "status": "succeeded", "customer": "c" if customers else None, "created": at,
        }
        first = [charge(2 * day, base + 10), charge(2 * day + 1, base + 20)]
        second = [charge(2 * day - 1 if day else 0, base + 30)]
        pages.append((base, 0, None, json.dumps({"data": first, "has_more": True})))
        pages.append((base, 1, first[-1]["id"], json.dumps({"data": second, "has_more": False})))
    df = spark.createDataFrame(pages, "chain_id BIGINT, page_no BIGINT, starting_after STRING, body STRING")
    df.coalesce(1).sortWithinPartitions("chain_id", "page_no").write.mode("overwrite").partitionBy("chain_id").parquet(path)


@pytest.fixture()
def config(tmp_path, monkeypatch):
    monkeypatch.setitem(paged.TRANSPORTS, "landed", landed.LandedPages)
    cloudpickle.register_pickle_by_value(landed)
    yield from _config(tmp_path)
    cloudpickle.unregister_pickle_by_value(landed)


def _config(tmp_path):
    yield ExtractConfig(
        root=str(tmp_path / "lake"),
        checkpoint_key=KEY,
        source={"transport": "landed", "transport.path": f"file://{tmp_path / 'pages'}"},
        as_of=datetime(2024, 1, 8),
        default_days=7,
    )


def mark(spark, config):
    row = read_checkpoints(spark, config.root).select("*", F.unix_seconds("last_extracted_timestamp").alias("at")).first()
    return row


def test_first_run_then_nothing_new(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    result = run_extract(spark, config)
    assert (result.exit_code, result.reason, result.records) == (0, "committed", 14)
    assert result.report["quality_check"] == "PASSED"
    assert mark(spark, config).at == START + 7 * DAY
    assert current_charges(spark, config.root).count() == 14
    assert run_extract(spark, config).reason == "nothing to extract"
    land(spark, str(tmp_path / "pages"), 9)
    later = ExtractConfig(**(vars(config) | {"as_of": config.as_of + timedelta(days=2)}))
    result = run_extract(spark, later)
    assert (result.reason, result.records) == ("committed", 4), "the buffer reads a day again and counts none of it"
    assert mark(spark, config).at == START + 9 * DAY
    assert (current_charges(spark, config.root).count(), mark(spark, config).records_extracted) == (18, 18)


def test_the_landed_set_is_read_in_few_passes(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    result = run_extract(spark, config)
    assert result.records == result.report["total_records"] == 14


def test_checkpoint_stops_at_a_failed_chunk(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    config.source["transport.fail_chain"] = str(START + 3 * DAY)
    result = run_extract(spark, config)
    assert (result.exit_code, result.failed_chunks) == (0, 1)
    assert mark(spark, config).at == START + 3 * DAY
    del config.source["transport.fail_chain"]
    assert run_extract(spark, config).exit_code == 0
    assert mark(spark, config).at == START + 7 * DAY
    assert current_charges(spark, config.root).count() == 14
    assert mark(spark, config).records_extracted == 14, "a repeated chunk counts once"


def test_everything_failed(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 1)
    config.as_of = datetime(2024, 1, 2)
    config.default_days = 1
    config.source["transport.fail_chain"] = str(START)
    result = run_extract(spark, config)
    assert (result.exit_code, result.failed_chunks) == (2, 1)
    assert mark(spark, config) is None


def test_quality_gate_leaves_the_run_uncommitted(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7, customers=False)
    result = run_extract(spark, config)
    assert (result.exit_code, result.report["quality_check"]) == (1, "FAILED")
    assert mark(spark, config) is None
    assert current_charges(spark, config.root).count() == 0
    config.dev = True
    assert run_extract(spark, config).exit_code == 0


def test_dry_run_writes_nothing(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    config.dry_run = True
    result = run_extract(spark, config)
    assert (result.exit_code, result.records) == (0, 14)
    assert not os.path.exists(config.root)


def test_mistyped_records_are_set_aside_and_stop_nothing(spark, tmp_path, config):
    day = [{"id": "a", "amount": "5", "created": START}, {"id": " ", "created": START}, {"id": "b", "amount": 5, "currency": "usd", "status": "s", "customer": "c", "created": START + 1}, "text"]
    page = [(START, 0, None, json.dumps({"data": day, "has_more": False}))]
    df = spark.createDataFrame(page, "chain_id BIGINT, page_no BIGINT, starting_after STRING, body STRING")
    df.coalesce(1).write.partitionBy("chain_id").parquet(str(tmp_path / "pages"))
    config.as_of, config.default_days = datetime(2024, 1, 2), 1
    result = run_extract(spark, config)
    assert (result.exit_code, result.records, result.rejected, result.failed_chunks) == (0, 1, 3, 0)
    assert mark(spark, config).at == START + DAY
    rejects = spark.read.parquet(f"{config.root}/rejects").collect()
    assert sorted(r._reasons for r in rejects) == ["malformed", "missing:id", "type:amount"]
    assert json.loads(next(r._reject for r in rejects if r._reasons == "type:amount"))["amount"] == "5"


def test_reset_starts_over_and_stays_in_the_history(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    run_extract(spark, config)
    reset_checkpoint(spark, config.root, KEY, "bad data", config.as_of + timedelta(hours=1))
    assert mark(spark, config) is None
    config.as_of += timedelta(hours=2)
    config.source["transport.fail_chain"] = str(START + 7 * DAY)
    result = run_extract(spark, config)
    assert (result.exit_code, result.reason, result.records) == (0, "no new records", 0)
    assert mark(spark, config).at == START + 7 * DAY
    history = read_runs(spark, config.root)
    assert history.where("is_reset").count() == 1 and history.count() == 3


def test_a_named_range_leaves_the_checkpoint_alone(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    config.start, config.end = datetime(2024, 1, 2), datetime(2024, 1, 4)
    result = run_extract(spark, config)
    assert (result.exit_code, result.records) == (0, 5)
    assert mark(spark, config) is None and current_charges(spark, config.root).count() == 5


def test_later_version_wins(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), 7)
    run_extract(spark, config)
    land(spark, str(tmp_path / "pages"), 7, version=-5)
    later = {"checkpoint_key": "backfill", "as_of": config.as_of + timedelta(days=1), "default_days": 8}
    again = ExtractConfig(**(vars(config) | later))
    assert run_extract(spark, again).exit_code == 0
    assert read_checkpoints(spark, config.root).count() == 2, "a backfill has its own checkpoint"
    assert {r.amount for r in current_charges(spark, config.root).collect()} == {95}


def runs(spark, marks):
    return spark.createDataFrame(
        [(KEY, f"run-{i}", m, 10, None, datetime(2024, 1, 1, i), None, None) for i, m in enumerate(marks)], RUN_SCHEMA
    )


def test_checkpoint_never_moves_back(spark):
    folded = fold_checkpoints(runs(spark, [datetime(2024, 1, 5), datetime(2024, 1, 3)])).first()
    assert folded.last_extracted_timestamp.day == 5
    assert (folded.records_extracted, folded.records_extracted_last_run, folded.updated_by) == (20, 10, "run-1")


def test_resume_point_with_and_without_a_checkpoint(spark):
    folded = fold_checkpoints(runs(spark, [datetime(2024, 1, 5, tzinfo=timezone.utc)]))
    default = datetime(2023, 1, 1)
    at = lambda key: spark.range(1).select(
        F.unix_seconds(resume_point(folded, key, "last_extracted_timestamp", default))
    ).first()[0]
    assert at(KEY) == START + 4 * DAY - 300
    assert at("other") == 1672531200
    empty = resume_points(folded.withColumn("t", F.lit(None).cast("timestamp")), "t", default)
    assert empty.select(F.unix_seconds("resume_at")).first()[0] == 1672531200


@pytest.mark.parametrize("failed, expected", [([], 3), ([2], 2), ([0, 2], 0), ([0, 1, 2], 0)])
def test_safe_mark_never_passes_a_failed_chunk(spark, failed, expected):
    df = spark.range(3).select(
        F.timestamp_seconds(F.col("id") * DAY).alias("start_ts"),
        F.timestamp_seconds((F.col("id") + 1) * DAY).alias("end_ts"),
        F.col("id").isin(failed).alias("failed") if failed else F.lit(False).alias("failed"),
    )
    got = safe_high_water_mark(df).select(F.unix_seconds("high_water_mark")).first()[0]
    assert got == expected * DAY
