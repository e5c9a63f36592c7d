"""Per-row quality scores, 0 to 100."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The columns that carry 20 points each.
COMPLETENESS_COLUMNS = ["id", "amount", "currency", "status", "customer"]
COMPLETENESS_POINTS = 20

# Weights of required columns, optional columns and validity rules.
WEIGHTS = (50.0, 30.0, 20.0)


def completeness_score() -> Column:
    """20 points per non-NULL column; an empty string counts as filled."""
    points = [F.when(F.col(c).isNotNull(), COMPLETENESS_POINTS).otherwise(0) for c in COMPLETENESS_COLUMNS]
    return reduce(add, points)


def is_filled(df: DataFrame, name: str) -> Column:
    """Not NULL and, for text columns, not the empty string; never NULL."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return column.isNotNull() & (column != "")
    return column.isNotNull()


def quality_score(df: DataFrame, required: list[str]) -> Column:
    """``100 // n`` points per filled column, so three columns reach 99 at most."""
    if not required:
        raise ValueError("quality_score needs at least one column")
    points = 100 // len(required)
    return reduce(add, [F.when(is_filled(df, c), points).otherwise(0) for c in required])


def weighted_quality_score(
    df: DataFrame,
    required: list[str],
    optional: list[str],
    valid: list[Column],
    weights: tuple[float, float, float] = WEIGHTS,
) -> Column:
    """Weighted share of required columns, optional columns and validity rules.

    A rule that evaluates to NULL is not met. An empty group earns its full weight.
    """

    def share(conditions: list[Column]) -> Column:
        if not conditions:
            return F.lit(1.0)
        met = reduce(add, [F.when(c, 1).otherwise(0) for c in conditions])
        return met / F.lit(float(len(conditions)))

    groups = ([is_filled(df, c) for c in required], [is_filled(df, c) for c in optional], valid)
    return reduce(add, [share(g) * F.lit(w) for g, w in zip(groups, weights)])
