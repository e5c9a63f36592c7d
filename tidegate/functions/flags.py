"""Boolean columns. Three-valued logic is kept unless the docstring says otherwise."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks a row as test data.
TEST_EMAIL_PATTERNS = ["test", "example.com", "test_"]
TEST_CUSTOMER_PREFIX = "test_"
TEST_AMOUNTS = [100, 1]
HIGH_VALUE_USD = 1000


def has_customer(customer: Column) -> Column:
    """Never NULL."""
    return customer.isNotNull() & (customer != "")


def is_fully_refunded(amount: Column, refunded: Column) -> Column:
    """NULL when either side is NULL; 0 refunded of 0 counts as full."""
    return refunded == amount


def is_high_value(amount_usd: Column) -> Column:
    return amount_usd > HIGH_VALUE_USD


def is_failed(status: Column) -> Column:
    return status == "failed"


def is_international(currency: Column) -> Column:
    return currency != "usd"


def is_negative(amount: Column) -> Column:
    return amount < 0


def is_stale(created: Column, as_of: Column, years: int = 2) -> Column:
    return created < as_of - F.make_interval(years=F.lit(years))


def test_email(email: Column, patterns: list[str] | None = None) -> Column:
    """Lower-cased address contains a pattern; NULL for a NULL address."""
    patterns = TEST_EMAIL_PATTERNS if patterns is None else patterns
    if not patterns:
        return F.lit(False)
    return reduce(or_, [F.lower(email).contains(p) for p in patterns])


def test_customer(customer: Column) -> Column:
    return customer.startswith(TEST_CUSTOMER_PREFIX)


def consistency_violations() -> Column:
    """Names of the violated rules, in this order; a NULL comparison is no violation."""
    rules = [
        ("captured_exceeds_amount", F.col("amount_captured") > F.col("amount")),
        ("refund_exceeds_captured", F.col("amount_refunded") > F.col("amount_captured")),
        (
            "refunded_flag_mismatch",
            F.col("refunded") != ((F.col("amount_refunded") == F.col("amount")) & (F.col("amount") > 0)),
        ),
        ("paid_status_mismatch", F.col("paid") != (F.col("status") == "succeeded")),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
