"""Amounts. Cents stay BIGINT; only the columns named ``*_usd`` are DOUBLE."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_usd(cents: Column) -> Column:
    return cents / F.lit(100.0)


def refund_rate(amount: Column, refunded: Column) -> Column:
    """Refunded share of a positive amount; 0.0 for amounts <= 0 and for NULL."""
    return F.when(amount > 0, refunded / amount).otherwise(F.lit(0.0))
