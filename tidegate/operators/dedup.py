"""Duplicates by key.

The keep-latest operators are aggregates, not window functions: copies are
combined before the shuffle, so a key that holds a third of all rows costs one
row per map task instead of one giant window partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from tidegate.session import scratch_path

# Newest first, then a fixed order of the other columns so that ties never depend on the plan.
CHARGE_ORDER = [
    "-created",
    "-amount",
    "status",
    "customer",
    "receipt_email",
    "currency",
    "amount_refunded",
]


def _descending(df: DataFrame, name: str) -> tuple[Column, Callable[[Column], Column]]:
    """An ascending stand-in for a column in descending order, and its inverse."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, IntegralType):
        return F.bitwise_not(column), F.bitwise_not
    if isinstance(kind, TimestampType):
        return F.bitwise_not(F.unix_micros(column)), lambda key: F.timestamp_micros(F.bitwise_not(key))
    if isinstance(kind, TimestampNTZType):
        micros = F.unix_micros(column.cast("timestamp"))
        return F.bitwise_not(micros), lambda key: F.timestamp_micros(F.bitwise_not(key)).cast("timestamp_ntz")
    if isinstance(kind, DateType):
        return F.bitwise_not(F.unix_date(column)), lambda key: F.date_from_unix_date(F.bitwise_not(key))
    raise TypeError(f"descending order is not supported for {name}: {kind.simpleString()}")


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``, NULLs last; remaining columns break ties.

    ``order`` lists column names, with ``-`` in front for descending. NULL keys
    form one group. Columns must be orderable (no maps). The sort key doubles as
    the carrier of its columns, so no value is shuffled twice.
    """
    fields, restored = [], {}
    for position, item in enumerate(order):
        name = item.removeprefix("-")
        key, inverse = _descending(df, name) if item.startswith("-") else (F.col(name), lambda column: column)
        fields += [F.col(name).isNull().alias(f"null{position}"), key.alias(f"key{position}")]
        restored[name] = inverse(F.col(f"best.key{position}"))
    rest = [c for c in df.columns if c not in restored and c not in keys]
    best = F.min(F.struct(*fields, *[F.col(c).alias(f"row_{c}") for c in rest])).alias("best")
    output = {c: restored[c] if c in restored else F.col(c if c in keys else f"best.row_{c}") for c in df.columns}
    return df.groupBy(*keys).agg(best).select(*[column.alias(c) for c, column in output.items()])


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys; with other columns kept, the surviving row would be arbitrary."""
    return df.select(*keys).dropDuplicates(keys)


def flag_duplicates(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep every row and add ``is_duplicate``: false for exactly one row of each key.

    (Specified here.) The survivor of a key is the first row in ``order``; all columns
    and then a row number break ties, so exact copies are told apart. Keys are reduced
    by a pre-aggregated minimum, and the rows join their survivor on that number, so
    neither a hot key nor a hot group of copies meets in one task.
    """
    columns = df.columns
    # Written once: the number that tells exact copies apart must not change between its two uses.
    numbered = df.withColumn("_n", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "flagged")
    numbered.write.parquet(path)
    stored = df.sparkSession.read.schema(numbered.schema).parquet(path)
    survivor = keep_latest(stored, keys, order).select("_n", F.lit(False).alias("_is_duplicate"))
    return stored.join(survivor, "_n", "left").select(*columns, F.coalesce("_is_duplicate", F.lit(True)).alias("is_duplicate"))


def duplicate_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after a dedupe, rows removed, and their share (NULL when empty)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial_count"), F.count("*").alias("final_count")
    )
    removed = F.col("initial_count") - F.col("final_count")
    return counts.select(
        "initial_count",
        "final_count",
        removed.alias("duplicates_removed"),
        (removed / F.nullif(F.col("initial_count"), F.lit(0))).alias("duplicate_rate"),
    )
