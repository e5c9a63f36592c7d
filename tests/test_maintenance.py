"""Compaction, retention, checksums, sketches, quantiles and silences beyond what the queries show."""

import os
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tabular import rows

from tidegate.operators import layout, logs, quantiles, reconcile, sketches
from tidegate.sinks import commits, datasets, maintenance
from tidegate.streaming import jobs

AT = datetime(2024, 2, 1)


def days(spark, ids, n_days=3):
    return spark.createDataFrame([(f"k{i}", i, date(2024, 1, 1 + i % n_days)) for i in ids], "id STRING, n BIGINT, dt DATE")


def small_runs(spark, root, runs=4):
    for r in range(runs):
        datasets.write_run(days(spark, range(r * 9, r * 9 + 9)), root, f"r{r}")
        datasets.commit_run(spark, root, f"r{r}", 9, AT)


def test_compaction_leaves_the_rows_and_packs_the_files(spark, tmp_path):
    root = str(tmp_path / "lake")
    small_runs(spark, root)
    before = datasets.read_committed(spark, root)
    expected = rows(before.select("id", "n", "dt"))
    report = lambda: {r.dt: (r.files, r.compact) for r in layout.small_file_report(maintenance.visible_files(spark, root), ["dt"]).collect()}
    assert set(report().values()) == {(4, True)}
    assert maintenance.compact(spark, root, "c1", AT) == 12
    assert set(report().values()) == {(1, False)}
    assert rows(datasets.read_committed(spark, root).select("id", "n", "dt")) == expected
    assert rows(before.select("id", "n", "dt")) == expected, "a reader that began before sees the state of then"
    assert maintenance.compact(spark, root, "c2", AT) == 0
    assert maintenance.vacuum(spark, root, AT) == [], "within the grace period the old files stay"
    gone = maintenance.vacuum(spark, root, AT + timedelta(days=2))
    assert len(gone) == 12 and {why for _, why in gone} == {"replaced"}
    assert rows(datasets.read_committed(spark, root).select("id", "n", "dt")) == expected


def test_only_small_parts_are_packed_and_into_bins_of_the_target(spark):
    sizes = {"a": 90, "b": 40, "c": 30, "d": 25, "e": 20, "f": 10}
    files = spark.createDataFrame([(r, date(2024, 1, 1), n) for r, n in sizes.items()] + [("a", date(2024, 1, 2), 5)], "run_id STRING, dt DATE, length BIGINT")
    plan = maintenance.compaction_plan(files, 100).collect()
    assert {(r.run_id, r.bin) for r in plan} == {("b", 0), ("c", 0), ("d", 0), ("e", 0)} | set(), "a is no small file, f would be alone in its bin, and so is the second date's"


def test_two_compactions_of_the_same_parts_cannot_both_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    small_runs(spark, root, 2)
    run_path, other = datasets.run_path, []

    def overtaken(root, run_id):
        if run_id == "c1" and not other:
            other.append(maintenance.compact(spark, root, "c0", AT))
        return run_path(root, run_id)

    monkeypatch.setattr(datasets, "run_path", overtaken)
    with pytest.raises(commits.CommitConflict):
        maintenance.compact(spark, root, "c1", AT)
    assert datasets.read_committed(spark, root).count() == 18
    assert {r.run_id for r in datasets.read_committed(spark, root).select("run_id").collect()} == {"c0"}


def test_retention_hides_first_and_deletes_later(spark, tmp_path):
    root = str(tmp_path / "lake")
    small_runs(spark, root, 2)
    datasets.write_run(days(spark, range(100, 103)), root, "crashed")
    assert maintenance.expire(spark, root, "e1", datetime(2024, 1, 12), 10) == date(2024, 1, 2)
    assert {str(r.dt) for r in datasets.read_committed(spark, root).select("dt").distinct().collect()} == {"2024-01-02", "2024-01-03"}
    assert os.path.isdir(f"{root}/data/run_id=r0/dt=2024-01-01")
    late = datetime.now() + timedelta(days=30)
    planned = maintenance.vacuum(spark, root, late, dry_run=True)
    assert os.path.isdir(f"{root}/data/run_id=r0/dt=2024-01-01")
    assert maintenance.vacuum(spark, root, late) == planned
    assert sorted(why for _, why in planned) == ["expired", "expired", "uncommitted"]
    assert not os.path.exists(f"{root}/data/crashed") and not os.path.exists(f"{root}/data/run_id=r0/dt=2024-01-01")
    assert datasets.read_committed(spark, root).count() == 12


def test_checksums_leave_equal_partitions_unread(spark, tmp_path):
    source = days(spark, range(60), 6)
    datasets.write_partitioned(source, str(tmp_path / "s"))
    written = source.where("id <> 'k14'").unionByName(days(spark, [20], 6))
    datasets.write_partitioned(written, str(tmp_path / "w"))
    s, w = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "w"))
    found = reconcile.reconcile_changed(s, w, ["id"], reconcile.checksums(s, ["id"]), reconcile.checksums(w, ["id"]))
    assert rows(found) == rows(layout.reconcile_ids(s, w, ["id"])) == [("k14", 1, 0), ("k20", 1, 2)]
    # Both keys lie on the third date: of the six scans, the two that read keys open its files alone.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 6 and sum("(dt#" in line and "= 2024-01-03)" in line for line in scans) == 2
    same = reconcile.reconcile_changed(s, s, ["id"], reconcile.checksums(s, ["id"]), reconcile.checksums(s, ["id"]))
    assert rows(same) == []
    empty = s.limit(0)
    assert len(rows(reconcile.reconcile_changed(s, empty, ["id"], reconcile.checksums(s, ["id"]), reconcile.checksums(empty, ["id"])))) == 60


def test_merged_sketches_are_near_the_exact_figures(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("key"), (F.col("id") * 7919 % 1_000_003).alias("value"), (F.col("id") % 10).alias("run"))
    merged = sketches.merge_sketches(sketches.partial_sketches(df, ["run"], "key", "value"), []).first()
    assert merged.records == 200_000 and abs(merged.distinct_keys - 50_000) < 50_000 * 0.033
    exact = df.select(F.expr("percentile(value, 0.5)")).first()[0]
    assert abs(merged.quantile - exact) < 1_000_003 * 0.005
    nothing = spark.createDataFrame([(1, None, None)], "run INT, key BIGINT, value BIGINT")
    got = sketches.merge_sketches(sketches.partial_sketches(nothing, ["run"], "key", "value"), ["run"]).first()
    assert (got.records, got.distinct_keys, got.quantile) == (1, 0, None)


@pytest.mark.parametrize("quantile", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_equal_percentile(spark, quantile):
    wide = [(g, float(v) ** 5 / 7) for g in ("a", "b", None) for v in range(-40, 60 if g else 3)]
    df = spark.createDataFrame(wide + [("one", 3.5), ("ties", 2.0), ("ties", 2.0), ("ties", 9.0), ("none", None)], "g STRING, v DOUBLE")
    got = {r.g: r.quantile for r in quantiles.exact_quantile(df, "v", quantile, ["g"]).collect()}
    exact = {r.g: r.q for r in df.groupBy("g").agg(F.expr(f"percentile(v, {quantile})").alias("q")).where("q IS NOT NULL").collect()}
    assert got.keys() == exact.keys() and all(abs(got[g] - exact[g]) <= 1e-9 * abs(exact[g]) for g in got)


def test_the_median_of_a_whole_table_and_of_none(spark):
    values = [(i * i * 31 % 10_007,) for i in range(5001)]
    df = spark.createDataFrame(values, "v BIGINT")
    assert quantiles.exact_quantile(df, "v").first().quantile == statistics.median(v for (v,) in values)
    assert quantiles.exact_quantile(df.limit(0), "v").count() == 0


def test_a_silence_that_goes_on_is_reported(spark):
    t = lambda minute: datetime(2024, 1, 1, 12, minute)
    log = spark.createDataFrame([("a", t(0)), ("a", t(20)), ("b", t(5)), ("b", t(38)), ("c", t(30)), (None, t(1)), ("d", t(50))], "job STRING, ts TIMESTAMP")
    got = logs.silences(log, by=["job"], as_of=t(40))
    assert rows(got) == sorted([("a", t(0), t(20), 1200.0), ("a", t(20), None, 1200.0), ("b", t(5), t(38), 1980.0), (None, t(1), None, 2340.0)], key=repr)
    assert logs.silences(log, by=["job"]).columns == got.columns


def test_the_stream_reports_a_silence_without_a_further_line(spark, tmp_path):
    t = lambda minute: datetime(2024, 1, 1, 12, minute)
    lines = spark.createDataFrame([("quiet", t(0)), ("quiet", t(10)), ("busy", t(0)), ("busy", t(14)), ("busy", t(31))], "job STRING, ts TIMESTAMP")
    lines.coalesce(1).write.parquet(str(tmp_path / "lines"))
    alerts = jobs.open_silences(jobs.read_files(spark, str(tmp_path / "lines"), lines.schema), "ts", "job", minutes=15)
    got = jobs.run_to_parquet(alerts, str(tmp_path / "out"), str(tmp_path / "state"))
    assert rows(got) == [("quiet", t(10))]


def test_a_copy_that_arrives_a_day_late_is_dropped(spark, tmp_path):
    root, state, path = (str(tmp_path / n) for n in ("lake", "state", "in"))
    first, late = days(spark, range(30)), days(spark, [0, 7, 29, 30, 30])
    first.write.parquet(path)
    stream = lambda: jobs.read_files(spark, path, first.schema)
    assert jobs.run_deduplicated(stream(), root, state, ["id"]).count() == 30
    late.write.mode("append").parquet(path)
    got = jobs.run_deduplicated(stream(), root, state, ["id"])
    assert rows(got.select("id")) == sorted([(f"k{i}",) for i in range(31)], key=repr)
    assert [r.rows for r in commits.read_log(spark, root).orderBy("version").collect()] == [30, 1]
