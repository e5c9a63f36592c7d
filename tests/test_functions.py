from datetime import datetime
from itertools import product

import pytest
from tabular import rows
from pyspark.sql import functions as F

from tidegate.functions import flags, money, scores, text, times
from tidegate.operators import enrich, filters, quality


def test_refund_rate_by_amount_and_refund(spark):
    cases = list(product([0, -5, None, 100], [0, 50, 100, None]))
    df = spark.createDataFrame(cases, "a BIGINT, r BIGINT")
    got = {(r.a, r.r): r.rate for r in df.select("a", "r", money.refund_rate(F.col("a"), F.col("r")).alias("rate")).collect()}
    for (a, r), rate in got.items():
        assert rate == ((None if r is None else r / a) if a is not None and a > 0 else 0.0)


def test_completeness_counts_every_subset_and_blanks(spark):
    cases = list(product(("x", None), (5, None), ("", None), ("s", None), ("", None)))
    df = spark.createDataFrame(cases, "id STRING, amount BIGINT, currency STRING, status STRING, customer STRING")
    for row in df.select("*", scores.completeness_score().alias("score")).collect():
        assert row.score == 20 * sum(v is not None for v in row[:5])


@pytest.mark.parametrize("columns, full", [(["a"], 100), (["a", "b", "n"], 99), (["a", "b", "n", "a", "b"], 100)])
def test_quality_score(spark, columns, full):
    df = spark.createDataFrame([("x", "y", 1), ("", None, None), ("x", "", 0)], "a STRING, b STRING, n BIGINT")
    got = [r.quality_score for r in enrich.add_quality_score(df, columns).collect()]
    points = 100 // len(columns)
    assert got[0] == full
    assert got[1] == 0
    assert got[2] == points * sum(c in ("a", "n") for c in columns)


def test_quality_score_needs_columns(spark):
    with pytest.raises(ValueError):
        enrich.add_quality_score(spark.range(1), [])


def test_weighted_score_without_optional_columns(spark):
    df = spark.createDataFrame([("x", 5), (None, -1)], "a STRING, n BIGINT")
    score = scores.weighted_quality_score(df, ["a", "n"], [], [F.col("n") >= 0])
    assert [r[0] for r in df.select(score).collect()] == [100.0, 55.0]


def test_three_valued_flags(spark):
    df = spark.createDataFrame(
        [(1, 1, "usd", "failed"), (0, 0, "USD", "ok"), (None, 1, None, None)],
        "amount BIGINT, amount_refunded BIGINT, currency STRING, status STRING",
    )
    got = enrich.add_business_flags(df.transform(enrich.add_amount_usd)).select(
        "is_high_value", "is_failed", "is_fully_refunded", "is_international"
    )
    assert [tuple(r) for r in got.collect()] == [
        (False, True, True, False),
        (False, False, True, True),
        (None, None, None, None),
    ]


def test_high_value_is_strict(spark):
    df = spark.createDataFrame([(1000.0,), (1000.01,)], "u DOUBLE")
    assert [r[0] for r in df.select(flags.is_high_value(F.col("u"))).collect()] == [False, True]


def test_test_rows_with_and_without_null_policy(spark):
    df = spark.createDataFrame(
        [("a@b.c", "cus"), ("QA@TEST.io", "cus"), (None, "cus"), ("a@b.c", None), ("a@b.c", "test_1"), ("a@b.c", "Test_1")],
        "receipt_email STRING, customer STRING",
    )
    kept = rows(filters.drop_test_rows(df))
    assert kept == sorted([("a@b.c", "cus"), (None, "cus"), ("a@b.c", None), ("a@b.c", "Test_1")], key=repr)
    compat = rows(filters.drop_test_rows(df, null_is_test=True))
    assert compat == sorted([("a@b.c", "cus"), ("a@b.c", "Test_1")], key=repr)
    assert rows(filters.drop_test_rows(df, patterns=["b.c"])) == [("QA@TEST.io", "cus"), (None, "cus")]
    assert filters.drop_test_rows(df.select("customer")).count() == 5
    assert filters.drop_test_rows(df.select(F.col("customer").alias("x"))).count() == 6
    stats = filters.test_row_stats(df, null_is_test=True).first()
    assert (stats.initial_count, stats.test_records, stats.test_rate) == (6, 4, 4 / 6)
    assert filters.test_row_stats(df.limit(0)).first().test_rate is None


@pytest.mark.parametrize(
    "total, low, dev, expected",
    [
        (0, 0, False, "FAILED"),
        (0, 0, True, "FAILED"),
        (100, 0, False, "PASSED"),
        (100, 5, False, "PASSED"),
        (10000, 501, False, "WARNING"),
        (100, 20, False, "WARNING"),
        (10000, 2001, False, "FAILED"),
        (100, 100, True, "PASSED"),
    ],
)
def test_verdict(spark, total, low, dev, expected):
    df = spark.createDataFrame([(total, low)], "t BIGINT, l BIGINT")
    assert df.select(quality.verdict(F.col("t"), F.col("l"), dev)).first()[0] == expected


def test_report_of_no_rows_has_the_same_columns(spark):
    df = spark.createDataFrame(
        [], "has_customer BOOLEAN, is_fully_refunded BOOLEAN, completeness_score INT, amount BIGINT, amount_usd DOUBLE"
    )
    report = quality.quality_report(df)
    assert report.first().quality_check == "FAILED"
    assert report.first().total_records == 0
    assert quality.quality_report(df, dev=True).first().completeness_threshold == 20


def test_timestamps_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(1793514600,), (1793511000,), (None,)], "created BIGINT")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        back = df.select(F.unix_seconds(times.created_timestamp(F.col("created"))))
        assert [r[0] for r in back.collect()] == [1793514600, 1793511000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_record_age_counts_calendar_days(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:00",)], "t STRING").select(F.col("t").cast("timestamp").alias("t"))
    age = times.record_age_days(F.col("t"), times.as_timestamp(datetime(2024, 1, 2, 0, 1)))
    assert df.select(age).first()[0] == 1


def test_iso_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00.9+02:00",), ("x",), ("",)], "t STRING")
    got = df.select(times.to_iso(times.from_iso(F.col("t")))).collect()
    assert [r[0] for r in got] == ["2024-01-01T10:00:00Z", "2024-01-01T08:00:00Z", None, None]


def test_mask(spark):
    df = spark.createDataFrame([(None,), ("",), ("abcd",), ("abcde",)], "s STRING")
    assert [r[0] for r in df.select(text.mask_sensitive(F.col("s"))).collect()] == ["****", "****", "****", "abcd****"]


def test_run_ids(spark):
    run_id = text.new_run_id(datetime(2024, 5, 6, 7, 8, 9))
    df = spark.createDataFrame([(run_id,), ("run-x",)], "r STRING")
    got = df.select(
        times.to_iso(text.run_started_at(F.col("r"))).alias("t"), text.run_suffix(F.col("r")).alias("s")
    ).collect()
    assert tuple(got[0]) == ("2024-05-06T07:08:09Z", run_id[-8:])
    assert tuple(got[1]) == (None, None)


def test_consistency_and_validity(spark):
    df = spark.createDataFrame(
        [(100, 100, 100, True, True, "succeeded"), (100, 200, 300, False, False, "succeeded"), (None,) * 6],
        "amount BIGINT, amount_captured BIGINT, amount_refunded BIGINT, refunded BOOLEAN, paid BOOLEAN, status STRING",
    )
    got = [r.violations for r in enrich.add_consistency(df).collect()]
    assert got == [[], ["captured_exceeds_amount", "refund_exceeds_captured", "paid_status_mismatch"], []]


def test_currency_conversion_by_dict_and_by_table(spark):
    df = spark.createDataFrame([("usd", 100), ("eur", 200), ("xyz", 300), (None, 400)], "currency STRING, amount BIGINT")
    rates = {"usd": 1.0, "eur": 1.5}
    table = spark.createDataFrame(list(rates.items()), "currency STRING, rate DOUBLE")
    expected = sorted(
        [("usd", 100, 1.0, 1.0, False), ("eur", 200, 1.5, 3.0, False), ("xyz", 300, None, None, True), (None, 400, None, None, True)],
        key=repr,
    )
    assert rows(enrich.convert_currency(df, rates)) == expected
    assert rows(enrich.convert_currency(df, table)) == expected


def test_column_completeness_and_metric_merge(spark):
    df = spark.createDataFrame([("a", 1), ("", None), (None, 3)], "s STRING, amount BIGINT")
    got = {r.column_name: (r.nulls, r.blanks) for r in quality.column_completeness(df, ["s", "amount"]).collect()}
    assert got == {"s": (1, 1), "amount": (1, 0)}
    merged = quality.merge_metrics(quality.partial_metrics(df.withColumn("g", F.lit(1)), ["g", "s"]), ["g"]).first()
    assert (merged.records, merged.total_usd, merged.avg_usd, merged.value_min, merged.value_max) == (3, 0.04, 0.02, 1, 3)


def test_salted_counts_equal_plain_counts(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("day"), (F.col("id") % 700).alias("key"))
    plain = df.groupBy("day").agg(F.count("*"), F.count_distinct("key"))
    assert rows(quality.salted_daily(df, "day", "key", 7)) == rows(plain)
