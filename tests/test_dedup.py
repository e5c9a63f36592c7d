import random
from datetime import date, datetime, timezone

import pytest
from tabular import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.operators import customers, dedup

SCHEMA = "id STRING, created BIGINT, amount BIGINT, status STRING"


def sample(spark, n=400, seed=1):
    pick = random.Random(seed)
    data = [
        (
            pick.choice(["", None, "a", "b", f"k{pick.randrange(40)}"]),
            pick.choice([None, 1, 2, 3]),
            pick.choice([None, -5, 0, 5]),
            pick.choice([None, "x", "y"]),
        )
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, SCHEMA).repartition(5)


def rank(row):
    down = lambda v: (v is None, 0 if v is None else -v)
    return down(row[1]), down(row[2]), (row[3] is None, row[3] or "")


def test_keep_latest_equals_brute_force_and_is_idempotent(spark):
    data, df = sample(spark)
    best = {}
    for row in data:
        if row[0] not in best or rank(row) < rank(best[row[0]]):
            best[row[0]] = row
    once = dedup.keep_latest(df, ["id"], ["-created", "-amount", "status"])
    assert rows(once) == sorted(best.values(), key=repr)
    assert rows(dedup.keep_latest(once, ["id"], ["-created", "-amount", "status"])) == rows(once)


def test_keep_latest_restores_dates_and_times(spark):
    early, late = datetime(2024, 1, 1, 1, 2, 3, 456789), datetime(2024, 1, 2)
    df = spark.createDataFrame([("a", early, date(2024, 1, 1)), ("a", late, date(2024, 1, 2))], "k STRING, t TIMESTAMP_NTZ, d DATE")
    assert dedup.keep_latest(df, ["k"], ["-t"]).collect() == [("a", late, date(2024, 1, 2))]
    assert dedup.keep_latest(df, ["k"], ["t"]).collect() == [("a", early, date(2024, 1, 1))]
    assert dedup.keep_latest(df, ["k"], ["-d"]).collect() == [("a", late, date(2024, 1, 2))]
    zoned = df.withColumn("t", F.col("t").cast("timestamp"))
    micros = dedup.keep_latest(zoned.where("d = '2024-01-01'"), ["k"], ["-t"]).select(F.unix_micros("t")).first()[0]
    assert micros == int(early.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000 + 456789


def test_descending_text_is_refused(spark):
    with pytest.raises(TypeError):
        dedup.keep_latest(sample(spark)[1], ["id"], ["-status"])


def test_flag_keeps_every_row_and_one_survivor_per_key(spark):
    data, df = sample(spark)
    flagged = dedup.flag_duplicates(df, ["id"], ["-created", "-amount", "status"]).cache()
    assert rows(flagged.drop("is_duplicate")) == sorted(data, key=repr)
    survivors = rows(flagged.where(~F.col("is_duplicate")).drop("is_duplicate"))
    assert survivors == rows(dedup.keep_latest(df, ["id"], ["-created", "-amount", "status"]))
    flagged.unpersist()


def test_duplicate_stats_treat_null_as_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "id STRING")
    assert tuple(dedup.duplicate_stats(df, ["id"]).first()) == (5, 3, 2, 0.4)
    assert tuple(dedup.duplicate_stats(df.limit(0), ["id"]).first()) == (0, 0, 0, None)


def test_customer_flags_equal_windows(spark):
    pick = random.Random(3)
    data = [(f"c{i}", pick.choice([None, "hot", "hot", f"u{pick.randrange(9)}"]), pick.randrange(20), pick.choice(["failed", "ok"])) for i in range(300)]
    df = spark.createDataFrame(data, "id STRING, customer STRING, created BIGINT, status STRING")
    place = Window.partitionBy("customer").orderBy("created", "id")
    known = F.col("customer").isNotNull()
    first = df.select("id", (known & (F.row_number().over(place) == 1)).alias("f"))
    assert rows(customers.flag_new_customers(df).select("id", "is_new_customer")) == rows(first)
    for n in (1, 2, 5):
        so_far = F.count_if(F.col("status") == "failed").over(place.rowsBetween(Window.unboundedPreceding, 0))
        risky = df.select("id", (known & (so_far >= n)).alias("f"))
        assert rows(customers.flag_refund_risk(df, n).select("id", "is_refund_risk")) == rows(risky)
