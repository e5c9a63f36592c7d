"""Flags that depend on a customer's earlier transactions. (Specified here.)

A window per customer would put the busiest customer into one task. Both flags
are decided by one bounded fact per customer instead, found by aggregation and
joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PLACE = ["created", "id"]


def flag_new_customers(df: DataFrame) -> DataFrame:
    """``is_new_customer``: the customer's first row by (created, id); false without a customer.

    Expects one row per id. The join key is the row itself, not the customer, so
    the rows of a busy customer spread over all tasks.
    """
    first = (
        df.where(F.col("customer").isNotNull())
        .groupBy("customer")
        .agg(F.min(F.struct(*_PLACE)).alias("first"))
        .select("customer", *[F.col(f"first.{c}").alias(c) for c in _PLACE], F.lit(True).alias("is_new_customer"))
    )
    joined = df.join(first, ["customer", *_PLACE], "left")
    return joined.select(*df.columns, F.coalesce("is_new_customer", F.lit(False)).alias("is_new_customer"))


def flag_refund_risk(df: DataFrame, failures: int = 2, salts: int = 64) -> DataFrame:
    """``is_refund_risk``: at least ``failures`` failed payments up to and including the row.

    That is the case from the customer's n-th failed payment on. The rank filter
    keeps at most n rows per customer before anything is shuffled. The rows of a
    customer are dealt over ``salts`` groups by their id, each with a copy of that
    one fact, and rows without a customer have no fact and spread likewise.
    """
    place = Window.partitionBy("customer").orderBy(*_PLACE)
    nth = (
        df.where((F.col("status") == "failed") & F.col("customer").isNotNull())
        .select("customer", *_PLACE)
        .withColumn("n", F.row_number().over(place))
        .where(F.col("n") <= failures)
        .where(F.col("n") == failures)
        .select(
            F.col("customer").alias("of"),
            F.struct(*_PLACE).alias("from"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        )
    )
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64("id", "created"), F.lit(salts)).cast("int"))
    joined = dealt.join(nth, (F.col("customer") == F.col("of")) & (F.col("_salt") == F.col("salt")), "left")
    risk = F.coalesce(F.struct(*_PLACE) >= F.col("from"), F.lit(False))
    return joined.select(*df.columns, risk.alias("is_refund_risk"))
