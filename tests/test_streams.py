from tabular import rows
from pyspark.sql import functions as F

from tidegate.streaming import jobs


def stage(spark, path, data):
    """Appends one file of (id, seconds, kind)."""
    df = spark.createDataFrame(data, "id STRING, s BIGINT, kind STRING")
    df.select("id", F.timestamp_seconds(F.col("s") + 1704067200).alias("ts"), "kind").coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).schema


def test_copies_in_the_same_and_in_a_later_batch_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def run(schema):
        stream = jobs.dedup_within(jobs.read_files(spark, source, schema, 1), "ts", ["id"])
        return jobs.run_to_parquet(stream, out, state)

    schema = stage(spark, source, [("a", 0, "x"), ("a", 60, "x"), ("b", 30, "x")])
    assert sorted(r.id for r in run(schema).collect()) == ["a", "b"]
    stage(spark, source, [("a", 120, "x"), ("c", 90, "x")])
    assert sorted(r.id for r in run(schema).collect()) == ["a", "b", "c"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_windows_appear_once_the_watermark_has_passed(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run(schema):
        stream = jobs.windowed_quality(jobs.read_files(spark, source, schema), "ts", F.col("kind") == "bad")
        return jobs.run_to_parquet(stream, out, state)

    hour = [(str(i), i * 60, "bad" if i < 9 else "ok") for i in range(60)]
    schema = stage(spark, source, [*hour, ("x", 3601, "ok")])
    assert run(schema).count() == 0
    stage(spark, source, [("y", 7300, "ok")])
    first = run(schema).select("records", "low_quality", "quality_check").collect()
    assert [tuple(r) for r in first] == [(60, 9, "WARNING")]


def test_sink_is_idempotent_per_batch(spark, tmp_path):
    source, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = stage(spark, source, [("a", 0, "x"), ("b", 1, "x")])
    stream = jobs.read_files(spark, source, schema, 1)
    jobs.run_to_batches(stream, root, state, ["id"])
    stage(spark, source, [("c", 2, "x"), (None, 3, "x")])
    got = jobs.run_to_batches(stream, root, state, ["id"])
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c"], "a NULL key costs its own row only"
    assert [r.id for r in jobs.rejected_rows(spark, root, schema).collect()] == [None]
    batch = spark.read.parquet(f"{root}/data/batch_id=0").drop("rejected")
    for _ in range(2):
        jobs._write_batch(root, ["id"])(batch, 7)
    assert rows(spark.read.parquet(f"{root}/audit/batch_id=7")) == [(2, 0)]
