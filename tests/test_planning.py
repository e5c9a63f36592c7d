"""What a run reads, commits and leaves behind, against an endpoint that serves any range."""

import os
from datetime import datetime, timedelta

import landed
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidegate.operators import chunks
from tidegate.plans import extract
from tidegate.plans.extract import ExtractConfig, current_charges, plan_run, read_checkpoints, read_runs, reset_checkpoint, run_extract
from tidegate.plans.run_states import run_states
from tidegate.sinks import commits, datasets
from tidegate.sources import paged

DAY, HOUR = 86400, 3600
START = 1704067200  # 2024-01-01


def land(spark, path, created):
    rows = [(f"ch_{n:06d}", 100, "usd", "succeeded", "c", at) for n, at in enumerate(created)]
    df = spark.createDataFrame(rows, "id STRING, amount BIGINT, currency STRING, status STRING, customer STRING, created BIGINT")
    df.coalesce(1).write.mode("overwrite").parquet(path)


@pytest.fixture()
def config(tmp_path, monkeypatch):
    monkeypatch.setitem(paged.TRANSPORTS, "ranged", landed.RangedPages)
    cloudpickle.register_pickle_by_value(landed)
    os.mkdir(tmp_path / "calls")
    source = {"transport": "ranged", "transport.path": str(tmp_path / "pages"), "transport.calls": str(tmp_path / "calls")}
    yield ExtractConfig(root=str(tmp_path / "lake"), checkpoint_key="charges", source=source, as_of=datetime(2024, 1, 11), default_days=10)
    cloudpickle.unregister_pickle_by_value(landed)


def paged_chunks(tmp_path):
    """Chunks asked for since the last call, each as often as it was."""
    folder = tmp_path / "calls"
    found = sorted(tuple(map(int, name.split("-")[:2])) for name in os.listdir(folder))
    for name in os.listdir(folder):
        os.unlink(folder / name)
    return found


def mark(spark, config):
    return read_checkpoints(spark, config.root).select(F.unix_seconds("last_extracted_timestamp")).first()[0]


def daily(days, per_day=3):
    return [START + d * DAY + 60 * n for d in range(days) for n in range(per_day)]


def test_only_gaps_and_what_is_new_are_paged(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), daily(12))
    config.source["transport.fail"] = f"{START + 3 * DAY},{START + 7 * DAY}"
    result = run_extract(spark, config)
    assert (result.exit_code, result.failed_chunks, result.records) == (0, 2, 24)
    assert mark(spark, config) == START + 3 * DAY
    assert len(paged_chunks(tmp_path)) == 10
    config.source["transport.fail"] = f"{START + 7 * DAY}"
    result = run_extract(spark, config)
    assert paged_chunks(tmp_path) == [(START + d * DAY, START + (d + 1) * DAY) for d in (3, 7)]
    assert (result.records, mark(spark, config)) == (3, START + 7 * DAY), "the mark moves to the gap that is left"
    config.source["transport.fail"] = ""
    config.as_of += timedelta(days=2)
    result = run_extract(spark, config)
    # The buffer before the frontier lies in day 9.
    assert paged_chunks(tmp_path) == [(START + d * DAY, START + (d + 1) * DAY) for d in (7, 9, 10, 11)]
    assert (result.records, mark(spark, config)) == (9, START + 12 * DAY)
    assert current_charges(spark, config.root).count() == 36 == read_checkpoints(spark, config.root).first().records_extracted


def test_a_busy_hour_is_cut_by_the_counts_of_earlier_runs(spark, tmp_path, config):
    busy = [START + d * DAY + 9 * HOUR + 6 * n for d in range(4) for n in range(500)]
    land(spark, str(tmp_path / "pages"), sorted(daily(4) + busy))
    config.as_of, config.default_days, config.target_records = datetime(2024, 1, 3), 2, 100
    assert run_extract(spark, config).records == 2 * 503
    assert len(paged_chunks(tmp_path)) == 2, "without a history there is nothing to cut by"
    config.as_of = datetime(2024, 1, 5)
    assert run_extract(spark, config).records == 2 * 503
    read = paged_chunks(tmp_path)
    assert read[0][0] == START + DAY and read[-1][1] == START + 4 * DAY, "the buffer, then what is new"
    assert all(a[1] == b[0] for a, b in zip(read, read[1:])), "neither a gap nor an overlap"
    for day in (1, 2, 3):
        hour = START + day * DAY + 9 * HOUR
        assert sum(lo < hour + HOUR and hi > hour for lo, hi in read) >= 5
    stored = current_charges(spark, config.root)
    assert stored.count() == 4 * 503 == datasets.read_committed(spark, config.root).count()


def test_of_two_runs_from_the_same_checkpoint_one_commits_a_window(spark, tmp_path, config, monkeypatch):
    land(spark, str(tmp_path / "pages"), daily(10))
    write_run, inner = datasets.write_run, []

    def overtaken(*args, **kwargs):
        written = write_run(*args, **kwargs)
        if not inner:  # the other run starts after this one has planned, and commits first
            inner.append(None)
            inner[0] = run_extract(spark, config)
        return written

    monkeypatch.setattr(datasets, "write_run", overtaken)
    outer = run_extract(spark, config)
    assert (inner[0].reason, inner[0].records) == ("committed", 30)
    assert (outer.reason, outer.records) == ("nothing to extract", 0), "planned anew, and all was there"
    assert datasets.read_committed(spark, config.root).count() == 30
    assert read_runs(spark, config.root).count() == 1 and read_checkpoints(spark, config.root).first().records_extracted == 30
    details = [r.detail for r in run_states(spark, config.root, config.as_of).collect()]
    assert sum((d or "").startswith("conflict") for d in details) == 1


def test_a_reset_while_a_run_is_under_way_voids_it(spark, tmp_path, config, monkeypatch):
    land(spark, str(tmp_path / "pages"), daily(10))
    write_run, resets = datasets.write_run, []

    def reset_once(*args, **kwargs):
        if not resets:
            resets.append(reset_checkpoint(spark, config.root, "charges", "wrong data", config.as_of))
        return write_run(*args, **kwargs)

    monkeypatch.setattr(datasets, "write_run", reset_once)
    result = run_extract(spark, config)
    assert (result.reason, result.records) == ("committed", 30)
    assert [r.kind for r in commits.read_log(spark, config.root).orderBy("version").collect()] == ["reset", "commit"]


def test_numbers_of_the_log_are_taken_once(spark, tmp_path):
    root = str(tmp_path / "lake")
    entry = lambda run, **fields: commits.new_entry("commit", run, datetime(2024, 1, 1), **fields)
    assert commits.append(spark, root, entry("a"), 0) == 1
    assert not commits.create_once(spark, f"{root}/commits/{1:012d}.json", "{}")
    assert commits.append(spark, root, entry("b"), 0) == 2, "what excludes nothing takes the next number"
    with pytest.raises(commits.CommitConflict, match="number 2"):
        commits.append(spark, root, entry("c"), 1, lambda other: other["run_id"] == "b")
    assert commits.versions(spark, root) == [1, 2] and sorted(os.listdir(f"{root}/commits"))[0] != "_draft"
    snapshot = commits.read_log(spark, root)
    commits.append(spark, root, entry("d"), 2)
    assert snapshot.count() == 2 and commits.read_log(spark, root).count() == 3


def test_gated_failed_and_killed_runs_leave_their_states(spark, tmp_path, config, monkeypatch):
    land(spark, str(tmp_path / "pages"), daily(10))
    state = lambda as_of: sorted((r.status, r.detail) for r in run_states(spark, config.root, as_of).collect())
    monkeypatch.setattr(extract, "quality_report", lambda *_: spark.createDataFrame([("FAILED",)], "quality_check STRING"))
    assert run_extract(spark, config).exit_code == 1
    assert state(config.as_of) == [("gated", "audit failed: quality")]
    monkeypatch.undo()
    monkeypatch.setitem(paged.TRANSPORTS, "ranged", landed.RangedPages)

    def stop(error):
        def raising(*_, **__):
            raise error

        return raising

    monkeypatch.setattr(datasets, "write_run", stop(OSError("disk full")))
    with pytest.raises(OSError):
        run_extract(spark, config)
    monkeypatch.setattr(datasets, "write_run", stop(SystemExit(137)))
    with pytest.raises(SystemExit):
        run_extract(spark, config)
    monkeypatch.undo()
    assert state(config.as_of + timedelta(minutes=30)) == [("failed", "OSError: disk full"), ("gated", "audit failed: quality"), ("running", None)]
    later = run_states(spark, config.root, config.as_of + timedelta(hours=3)).where("status = 'lost'").collect()
    assert len(later) == 1 and later[0].end_time is not None
    monkeypatch.setitem(paged.TRANSPORTS, "ranged", landed.RangedPages)
    assert run_extract(spark, config).records == 30, "nothing of the three was committed"


def test_gaps_of_chunks_that_overlap_repeat_and_fail(spark):
    states = lambda rows: spark.createDataFrame(rows, "start_s BIGINT, end_s BIGINT, failed BOOLEAN")
    gaps = lambda rows, lo, hi: [tuple(r) for r in chunks.coverage_gaps(states(rows), lo, hi).orderBy("start_s").collect()]
    rows = [(0, 10, False), (10, 20, True), (20, 30, False), (5, 12, False), (25, 40, False), (0, 10, False), (50, 60, False)]
    assert gaps(rows, 0, 60) == [(12, 20), (40, 50)]
    assert gaps(rows, -5, 70) == [(-5, 0), (12, 20), (40, 50), (60, 70)]
    assert gaps(rows, 15, 45) == [(15, 20), (40, 45)]
    assert gaps([], 0, 10) == [(0, 10)] and gaps([(0, 10, True)], 0, 10) == [(0, 10)] and gaps(rows, 0, 0) == []


def test_plans_of_a_named_range_ignore_the_checkpoint(spark, tmp_path, config):
    land(spark, str(tmp_path / "pages"), daily(10))
    run_extract(spark, config)
    config.start, config.end = datetime(2024, 1, 2), datetime(2024, 1, 4)
    assert plan_run(spark, config, 0).chunks == [(START + d * DAY, START + (d + 1) * DAY) for d in (1, 2)]
