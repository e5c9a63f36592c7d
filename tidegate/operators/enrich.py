"""Row-wise enrichment of charges and of any frame with similar columns."""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import flags, money, scores, text, times
from tidegate.operators.dedup import CHARGE_ORDER, keep_latest
from tidegate.operators.validate import keyed


def enrich(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All derived columns of a charge in one projection, without removing copies."""
    now = F.current_timestamp() if as_of is None else as_of
    created = times.created_timestamp(F.col("created"))
    return df.select(
        "*",
        created.alias("created_timestamp"),
        F.to_date(created).alias("dt"),
        F.hour(created).alias("hour"),
        money.cents_to_usd(F.col("amount")).alias("amount_usd"),
        money.cents_to_usd(F.col("amount_captured")).alias("amount_captured_usd"),
        money.cents_to_usd(F.col("amount_refunded")).alias("amount_refunded_usd"),
        money.refund_rate(F.col("amount"), F.col("amount_refunded")).alias("refund_rate"),
        flags.has_customer(F.col("customer")).alias("has_customer"),
        flags.is_fully_refunded(F.col("amount"), F.col("amount_refunded")).alias("is_fully_refunded"),
        times.record_age_days(created, now).alias("record_age_days"),
        scores.completeness_score().alias("completeness_score"),
        now.alias("processed_at"),
        F.to_date(now).alias("processing_date"),
    )


def enrich_charges(
    df: DataFrame, as_of: Column | None = None, order: list[str] | None = None, keep_blank: bool = False
) -> DataFrame:
    """One enriched row per id.

    Rows without an id (NULL or blank) cannot be told apart, so they are left out; see
    ``validate.keyed`` for them. ``keep_blank`` keeps them as one row per blank value instead.
    Every derived column depends on its own row alone, so the copies are removed
    first: only the narrow source columns are shuffled.
    """
    df = df if keep_blank else keyed(df, "id")
    return enrich(keep_latest(df, ["id"], CHARGE_ORDER if order is None else order), as_of)


def add_date_partitions(df: DataFrame, timestamp_col: str = "created_timestamp") -> DataFrame:
    ts = F.col(timestamp_col)
    return df.withColumns(
        {
            "dt": F.to_date(ts),
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
        }
    )


def add_amount_usd(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    """``<amount_col>_usd``: cents over 100 whatever the currency; see :func:`convert_currency`."""
    return df.withColumn(f"{amount_col}_usd", money.cents_to_usd(F.col(amount_col)))


def convert_currency(
    df: DataFrame,
    rates: DataFrame | dict[str, float],
    amount_col: str = "amount",
    currency_col: str = "currency",
) -> DataFrame:
    """Add ``rate``, ``<amount>_converted`` (NULL without a rate) and ``unknown_currency``.

    (Specified here.) No hint is given: Spark broadcasts the rates when their
    measured size allows and otherwise joins by shuffle, where adaptive execution
    splits a dominant currency. Of several rates of a code the largest counts, so
    that no row is multiplied; pass the valid ones only.
    """
    if isinstance(rates, dict):
        table = df.sparkSession.createDataFrame(list(rates.items()), "code STRING, rate DOUBLE")
    else:
        table = rates.select(F.col(currency_col).alias("code"), F.col("rate").cast("double").alias("rate"))
    table = table.groupBy("code").agg(F.max("rate").alias("rate"))
    joined = df.join(table, df[currency_col] == table["code"], "left").drop("code")
    return joined.select(
        "*",
        (money.cents_to_usd(F.col(amount_col)) * F.col("rate")).alias(f"{amount_col}_converted"),
        F.col("rate").isNull().alias("unknown_currency"),
    )


def add_processing_metadata(df: DataFrame, job_id: str, data_source: str, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumns(
        {
            "processed_at": now,
            "processing_date": F.to_date(now),
            "job_id": F.lit(job_id),
            "data_source": F.lit(data_source),
        }
    )


def add_quality_score(df: DataFrame, required: list[str]) -> DataFrame:
    return df.withColumn("quality_score", scores.quality_score(df, required))


def add_business_flags(df: DataFrame) -> DataFrame:
    """Needs ``amount_usd``; every flag is NULL where its input is NULL."""
    return df.withColumns(
        {
            "is_high_value": flags.is_high_value(F.col("amount_usd")),
            "is_failed": flags.is_failed(F.col("status")),
            "is_fully_refunded": flags.is_fully_refunded(F.col("amount"), F.col("amount_refunded")),
            "is_international": flags.is_international(F.col("currency")),
        }
    )


def add_validity_flags(df: DataFrame, as_of: Column, years: int = 2) -> DataFrame:
    """(Specified here.) Negative amounts and records older than ``years``."""
    return df.withColumns(
        {
            "is_negative": flags.is_negative(F.col("amount")),
            "is_stale": flags.is_stale(times.created_timestamp(F.col("created")), as_of, years),
        }
    )


def add_consistency(df: DataFrame) -> DataFrame:
    """(Specified here.) ``violations``: names of the rules between fields that do not hold."""
    return df.withColumn("violations", flags.consistency_violations())


def mask_columns(df: DataFrame, columns: list[str], visible: int = 4) -> DataFrame:
    return df.withColumns({c: text.mask_sensitive(F.col(c), visible) for c in columns})


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Chain operators; the result is one operator that applies them in order."""
    return lambda df: reduce(lambda frame, step: frame.transform(step), steps, df)
