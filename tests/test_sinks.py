import os
from datetime import datetime

import pytest
from tabular import rows
from pyspark.sql import functions as F

from tidegate.operators import layout, quality
from tidegate.plans.preflight import exit_code, preflight
from tidegate.sinks import datasets

AT = datetime(2024, 2, 1)


def frame(spark, days=3, n=30):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("dt"),
    )


def test_overwrite_replaces_only_the_partitions_present(spark, tmp_path):
    path = str(tmp_path)
    datasets.write_partitioned(frame(spark), path)
    datasets.write_partitioned(frame(spark, 1, 5), path)
    got = spark.read.parquet(path).groupBy(F.col("dt").cast("string")).count()
    assert rows(got) == [("2024-01-01", 5), ("2024-01-02", 10), ("2024-01-03", 10)]


def test_append_adds_and_dry_run_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    datasets.write_partitioned(frame(spark), path)
    datasets.write_partitioned(frame(spark), path, mode="append")
    assert spark.read.parquet(path).count() == 60
    dry = datasets.write_partitioned(frame(spark), str(tmp_path / "b"), dry_run=True)
    assert sorted(r.records for r in dry.collect()) == [10, 10, 10]
    assert not os.path.exists(tmp_path / "b")
    with pytest.raises(ValueError):
        datasets.write_partitioned(frame(spark), path, mode="upsert")


def test_files_are_few_and_snappy(spark, tmp_path):
    datasets.write_partitioned(frame(spark).repartition(6), str(tmp_path))
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) == 3 and all(".snappy." in f for f in files)
    inventory = layout.file_inventory(layout.data_files(spark, str(tmp_path)), ["dt"]).collect()
    assert [r.files for r in inventory] == [1, 1, 1] and all(r.bytes > 0 for r in inventory)
    assert layout.latest_partition(layout.data_files(spark, str(tmp_path))).first()[0] == "2024-01-03"


def test_rerun_of_a_run_changes_nothing_and_uncommitted_runs_are_invisible(spark, tmp_path):
    root = str(tmp_path)
    datasets.write_run(frame(spark), root, "r1")
    assert datasets.read_committed(spark, root).count() == 0
    written = datasets.write_run(frame(spark), root, "r1")
    datasets.commit_run(spark, root, "r1", 30, AT)
    datasets.write_run(frame(spark), root, "r2")
    assert rows(datasets.read_committed(spark, root).select("id", "dt")) == rows(frame(spark)) == rows(written.select("id", "dt"))


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    datasets.write_partitioned(frame(spark), str(tmp_path))
    df = spark.read.parquet(str(tmp_path)).where(F.col("dt") == F.lit("2024-01-02").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert df.count() == 10


def enriched(spark, ids, score=100):
    return spark.createDataFrame([(i, True, False, score, 5, 0.05, "2024-01-01") for i in ids],
        "id STRING, has_customer BOOLEAN, is_fully_refunded BOOLEAN, completeness_score INT, amount BIGINT, amount_usd DOUBLE, dt STRING")


@pytest.mark.parametrize(
    "ids, score, expected, broken",
    [
        (["a", "b"], 100, 2, set()),
        (["a", "b"], 100, 3, {"row_count"}),
        (["a", "a"], 100, 2, {"duplicate_keys"}),
        (["a", None], 100, 2, {"null_keys"}),
        (["a", "b"], 0, 2, {"quality"}),
    ],
)
def test_audit(spark, tmp_path, ids, score, expected, broken):
    written = datasets.write_run(enriched(spark, ids, score), str(tmp_path), "r")
    audit = datasets.audit_run(written, expected, ["id"], quality.quality_report(written)).collect()
    assert {r.check for r in audit if not r.passed} == broken
    assert len(audit) == 4


def test_verification_and_reconciliation(spark):
    source, written = frame(spark), frame(spark).where("id <> '4'")
    assert [r.verified for r in layout.verify_write(source, written).orderBy("dt").collect()] == [True, False, True]
    assert rows(layout.reconcile_ids(source, written, ["id"])) == [("4", 1, 0)]
    assert rows(layout.reconcile_ids(source, source, ["id"])) == []


def test_retention(spark):
    df = spark.createDataFrame([("staging", "2024-01-01"), ("staging", "2024-01-02"), ("curated", "2000-01-01")], "zone STRING, d STRING")
    df = df.select("zone", F.col("d").cast("date").alias("dt"))
    got = layout.expired_partitions(df, "2024-02-01")
    assert [(r.zone, str(r.dt), r.age_days) for r in got.collect()] == [("staging", "2024-01-01", 31)]


def test_paths(spark):
    row = spark.createDataFrame([("2026-02-12", 7)], "d STRING, h INT").select(F.col("d").cast("date").alias("d"), "h")
    got = row.select(
        layout.relative_path(F.col("d")),
        layout.relative_path(F.col("d"), F.col("h")),
        layout.relative_path(F.col("d"), None, F.lit("r1")),
    ).first()
    assert tuple(got) == ("dt=2026-02-12/", "dt=2026-02-12/hour=07/", "dt=2026-02-12/run_id=r1/")


def test_preflight_runs_every_check(spark, tmp_path):
    good = preflight(spark, lambda: spark.range(3), str(tmp_path / "sink"), str(tmp_path / "runs"))
    assert all(r.passed for r in good.collect()) and exit_code(good) == 0
    assert os.listdir(tmp_path / "sink") == ["_probe"], "the next probe replaces it"
    bad = preflight(spark, lambda: spark.read.parquet(str(tmp_path / "none")), "/proc/nowhere", str(tmp_path / "runs"))
    assert [r.passed for r in bad.collect()] == [False, False, True] and exit_code(bad) == 1
