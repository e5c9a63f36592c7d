import json
from datetime import datetime, timedelta

import pytest
from tabular import rows
from pyspark.sql import functions as F

from tidegate.operators import chunks, pages, validate
from tidegate.schema import CHARGE_COLUMNS


def plan(spark, start, end, hours):
    df = chunks.plan_chunks(spark, start, end, hours)
    return [(r[0], r[1], r[2]) for r in df.select("chunk_no", F.unix_seconds("start_ts"), F.unix_seconds("end_ts")).collect()]


def test_chunks_cover_the_range_without_overlap(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 3, 5, 30)
    for hours in (1, 24):
        got = sorted(plan(spark, start, end, hours))
        assert got[0][1] == 1704067200 and got[-1][2] == 1704067200 + int((end - start).total_seconds())
        assert all(a[2] == b[1] for a, b in zip(got, got[1:]))
        assert [c[0] for c in got] == list(range(len(got)))
        assert all(c[2] - c[1] == hours * 3600 for c in got[:-1])


def test_no_chunks_for_an_empty_range(spark):
    now = datetime(2024, 1, 1)
    assert plan(spark, now, now, 24) == []
    assert plan(spark, now, now - timedelta(hours=1), 24) == []
    assert len(plan(spark, now, now + timedelta(hours=24), 24)) == 1


def test_counts_include_empty_chunks(spark):
    start = datetime(2024, 1, 1)
    end = datetime(2024, 1, 3, 12)
    table = chunks.plan_chunks(spark, start, end, 24)
    events = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-03 00:00:00",), ("2024-01-03 20:00:00",), ("2023-12-31 23:00:00",)], "t STRING").select(
        F.col("t").cast("timestamp").alias("ts")
    )
    got = chunks.chunk_counts(events, "ts", table, start, end)
    assert [r.records for r in got.orderBy("chunk_no").collect()] == [1, 0, 1]
    assert [r.chunk_no for r in chunks.missing_chunks(table, got.where("records > 0")).collect()] == [1]


def test_balanced_chunks_cover_the_range_and_meet_the_target(spark):
    start, hours = datetime(2024, 1, 1), [0, 3, 100, 2, 2, 0, 7, 41, 1, 0]
    table = chunks.plan_chunks(spark, start, start + timedelta(hours=len(hours)), 1)
    loads = spark.createDataFrame(list(enumerate(hours)), "chunk_no BIGINT, records BIGINT")
    got = chunks.balance_chunks(table.join(loads, "chunk_no"), 10).orderBy("group_no")
    cut = got.select(F.unix_micros("start_ts"), F.unix_micros("end_ts"), "expected").collect()
    assert cut[0][0] == 1704067200_000000 and cut[-1][1] == 1704067200_000000 + len(hours) * 3600_000000
    assert all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    assert abs(sum(c[2] for c in cut) - sum(hours)) < 1e-6
    assert all(c[2] <= 20 for c in cut)


def test_skew_uses_the_exact_median(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 12), (4, 51)], "chunk_no BIGINT, records BIGINT")
    assert rows(chunks.skewed_chunks(df, factor=4.6)) == [(4, 51, 11.0)]
    assert rows(chunks.skewed_chunks(df, factor=4.7)) == []


PAGE = "chain_id BIGINT, page_no BIGINT, starting_after STRING, body STRING"


def body(ids, more):
    return json.dumps({"data": [{"id": i} for i in ids], "has_more": more})


def test_absent_envelope_fields_have_defaults(spark):
    df = spark.createDataFrame([(1, 0, None, "{}"), (1, 1, None, '{"has_more":true}'), (1, 2, None, body("ab", True))], PAGE)
    got = pages.parse_envelopes(df).select("page_no", F.size("data"), "has_more")
    assert rows(got) == [(0, 0, False), (1, 0, True), (2, 2, True)]
    assert pages.flatten_pages(df, ["page_no"]).count() == 2


def test_other_envelope_names(spark):
    df = spark.createDataFrame([(1, 0, None, '{"items":[{"id":"a"}],"more":true}')], PAGE)
    got = pages.parse_envelopes(df, data_field="items", has_more_field="more")
    assert rows(got.select(F.size("data"), "has_more")) == [(1, True)]


def test_chain_problems(spark):
    df = spark.createDataFrame(
        [
            (1, 0, None, body("ab", True)),
            (1, 1, "b", body("c", False)),
            (2, 0, None, body("ab", True)),
            (3, 0, None, body("ab", True)),
            (3, 2, "c", body("d", False)),
            (4, 0, None, body("a", True)),
            (4, 1, "x", body("b", False)),
            (5, 0, None, body("", True)),
        ],
        PAGE,
    )
    assert rows(pages.check_chains(pages.parse_envelopes(df))) == [
        (2, 0, "open_end"),
        (3, 0, "open_end"),
        (3, 2, "missing_page"),
        (4, 1, "wrong_cursor"),
        (5, 0, "empty_page"),
        (5, 0, "open_end"),
    ]


def test_page_totals_and_progress(spark):
    df = spark.createDataFrame([(1, 0, None, body("ab", True)), (1, 1, "b", body("c", False))], PAGE)
    parsed = pages.parse_envelopes(df)
    assert rows(pages.page_totals(parsed)) == [(1, 2, 3, 1)]
    assert rows(pages.page_progress(parsed)) == [(1, 0, 2, 2), (1, 1, 1, 3)]


def test_typed_ingest_drops_unknown_keys_and_fails_on_a_missing_key(spark):
    df = spark.createDataFrame([('{"id":"a","amount":5,"extra":{"x":1}}',)], "value STRING")
    got = validate.typed_ingest(df)
    assert got.columns == CHARGE_COLUMNS
    assert (got.first().id, got.first().amount, got.first().currency) == ("a", 5, None)
    bad = spark.createDataFrame([('{"amount":5}',)], "value STRING")
    with pytest.raises(Exception, match="missing:id"):
        validate.typed_ingest(bad).collect()
    for text in ('{"id":"a","amount":"5"}', '{"id":"a","amount":"many"}', '{"id":5}', '{"id":"a","amo', '[1]'):
        with pytest.raises(Exception, match="type:|malformed"):
            validate.typed_ingest(spark.createDataFrame([(text,)], "value STRING")).collect()


def test_reject_reasons(spark):
    texts = [
        '{"id":"a","amount":5,"paid":true}',
        '{"id":" ","amount":"x","paid":"maybe"}',
        '{"amount":null}',
        '{"id":"a","amo',
        '{"id":"a","amount":1.5}',
        '{"id":"a","amount":"5"}',
        '{"id":{"x":1},"currency":7}',
        None,
    ]
    checked = validate.validate_schema(spark.createDataFrame([(t,) for t in texts], "value STRING"))
    got = {r.raw: r.reasons for r in checked.collect()}
    assert [got[t] for t in texts] == [
        [],
        ["missing:id", "type:amount", "type:paid"],
        ["missing:id"],
        ["malformed"],
        ["type:amount"],
        ["type:amount"],
        ["type:id", "type:currency"],
        ["malformed"],
    ]
    assert validate.valid_rows(checked).columns == CHARGE_COLUMNS
    assert validate.valid_rows(checked).count() + validate.rejected_rows(checked).count() == len(texts)


@pytest.mark.parametrize("name", ["chunk_plan", "chunk_plan_balanced", "chunk_record_counts", "chunk_skew", "safe_high_water_mark", "backfill_gaps"])
def test_chunk_queries_equal_sql_over_all_events(spark, name):
    from compare import compare, connect

    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), name, sf) in ("", "both sides are empty")


def test_the_last_event_is_in_a_chunk(spark, tmp_path):
    from __spark_entry__ import queries

    # One event a day and, in the chunk that fails, two in the last three hours.
    start = datetime(2024, 1, 1)
    last = start + timedelta(days=5, hours=7)
    times = [start + timedelta(days=d) for d in range(6)] + [last - timedelta(hours=1), last]
    spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    run = lambda name: queries()[name](spark, str(tmp_path))
    assert run("chunk_record_counts").agg(F.sum("records")).first()[0] == len(times)
    assert abs(run("chunk_plan_balanced").agg(F.sum("expected")).first()[0] - len(times)) < 1e-6
    assert [(r.chunk_no, r.records) for r in run("backfill_gaps").collect()] == [(5, 3)]
    assert run("chunk_plan").agg(F.max("end_ts")).first()[0] == "2024-01-06 07:00:00.000001"
