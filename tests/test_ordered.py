import random

import pytest
from tabular import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.operators.ordered import _ranges, blocked, ordinal, running


def sample(spark, n=500):
    """One hot key, and many rows that share a single time."""
    pick = random.Random(5)
    data = [
        (pick.choice(["hot", "hot", "a", "b", None]), pick.choice([7, 7, None, pick.randrange(1000)]), i, pick.choice([None, 1, 5]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k STRING, t BIGINT, i BIGINT, v BIGINT").repartition(6)


@pytest.mark.parametrize("pieces", [None, 1, 40])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_a_window(spark, pieces, inclusive):
    df = sample(spark)
    last = Window.currentRow if inclusive else -1
    window = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, last)
    plain = df.select("*", F.coalesce(F.sum("v").over(window), F.lit(0)).alias("s"), F.max("v").over(window).alias("m"))
    values = {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    got = running(df, ["k"], ["t", "i"], values, inclusive, pieces)
    assert rows(got) == rows(plain)


def test_ranges_split_a_hot_bucket(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"), F.col("id").alias("i"))
    pieces = _ranges(df, ["k"], ["t", "i"], 16)
    largest = pieces.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest < 1000


def test_ordinal_is_dense(spark):
    got = ordinal(sample(spark), ["k"], ["t", "i"])
    plain = sample(spark).withColumn("ordinal", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")).cast("bigint"))
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_ordinal_goes_on_from_range_to_range(spark, pieces):
    order = [F.col("t") + 1, "i"]
    got = ordinal(sample(spark), ["k"], order, "n", pieces)
    plain = sample(spark).withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("lookback, block", [(1, 1), (3, 3), (3, 10), (7, 64), (5, 4)])
def test_blocked_trailing_mean_equals_a_window(spark, lookback, block):
    df = sample(spark).withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")).cast("bigint"))
    plain = df.withColumn("m", F.avg("i").over(Window.partitionBy("k").orderBy("n").rowsBetween(-lookback, -1)))
    cut = blocked(df, F.col("n"), lookback, block)
    window = Window.partitionBy("k", "_block").orderBy("n").rowsBetween(-lookback, -1)
    got = cut.withColumn("m", F.avg("i").over(window)).where("_own").select(plain.columns)
    assert rows(got) == rows(plain)
