"""Row filters and pass/reject splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import flags


def _test_conditions(df: DataFrame, patterns: list[str] | None) -> list[Column]:
    conditions = []
    if "receipt_email" in df.columns:
        conditions.append(flags.test_email(F.col("receipt_email"), patterns))
    if "customer" in df.columns:
        conditions.append(flags.test_customer(F.col("customer")))
    return conditions


def is_test_row(df: DataFrame, patterns: list[str] | None = None, null_is_test: bool = False) -> Column:
    """Email or customer looks like test data; absent columns are skipped. Never NULL.

    With ``null_is_test`` a missing email or customer counts as test data, which
    is what a negated SQL predicate in a filter amounts to.
    """
    result = F.lit(False)
    for condition in _test_conditions(df, patterns):
        result = result | F.coalesce(condition, F.lit(null_is_test))
    return result


def drop_test_rows(df: DataFrame, patterns: list[str] | None = None, null_is_test: bool = False) -> DataFrame:
    return df.where(~is_test_row(df, patterns, null_is_test))


def flag_test_rows(df: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """(Specified here.) ``is_test_data`` instead of dropping."""
    return df.withColumn("is_test_data", is_test_row(df, patterns))


def test_row_stats(df: DataFrame, patterns: list[str] | None = None, null_is_test: bool = False) -> DataFrame:
    test = F.count_if(is_test_row(df, patterns, null_is_test))
    return df.agg(
        F.count("*").alias("initial_count"),
        test.alias("test_records"),
        (test / F.nullif(F.count("*"), F.lit(0))).alias("test_rate"),
    )


def drop_test_amounts(df: DataFrame) -> DataFrame:
    """(Specified here.) Drop the usual trial amounts; NULL amounts stay."""
    return df.where(~F.coalesce(F.col("amount").isin(flags.TEST_AMOUNTS), F.lit(False)))


def low_completeness(df: DataFrame, threshold: int = 80) -> DataFrame:
    return df.where(F.col("completeness_score") < threshold)


def quarantine(df: DataFrame, score: Column, minimum: int = 70) -> DataFrame:
    """(Specified here.) ``disposition``: 'pass' or 'quarantine'; a NULL score is quarantined.

    One flagged frame rather than two filters: writing it partitioned by
    ``disposition`` separates both sets in a single pass.
    """
    passed = F.coalesce(score >= minimum, F.lit(False))
    return df.withColumn("disposition", F.when(passed, "pass").otherwise("quarantine"))
