"""Running and trailing computations that do not put a whole key into one task.

A plain ``Window.partitionBy(job)`` sends all rows of a job to one task. Here
the rows are cut into sampled ranges of equal size by (keys, order), each range
is handled by its own task, and what a range needs from its predecessors is
carried over:

* :func:`running` and :func:`ordinal` carry one summary row per (key, range),
* :func:`blocked` copies the last ``lookback`` rows of each block into the next.

NULL keys are a group of their own and NULLs in the order come first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import scratch_path

_COMBINE = {
    "sum": (F.sum, lambda carried, own: F.coalesce(carried, F.lit(0)) + F.coalesce(own, F.lit(0))),
    "max": (F.max, lambda carried, own: F.greatest(carried, own)),
}


def _ranges(df: DataFrame, keys: list[str], order: list[str], pieces: int | None = None) -> DataFrame:
    """``_bucket`` from a range partitioning by (keys, order).

    Range bounds are sampled anew in every job, so the result is written once
    and read back: all later uses see the same ranges, also after a task is lost.
    """
    wanted = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _written(df.repartitionByRange(wanted, *keys, *order).withColumn("_bucket", F.spark_partition_id()), "ranges")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    pieces: int | None = None,
) -> DataFrame:
    """Add running ``sum``/``max`` columns per key in ``order``.

    A range is the unit of parallelism, and one summary row per key and range is
    all that the second, small window sees. ``order`` must be total for sums to
    be repeatable. ``pieces`` is the number of ranges, by default that of the
    session's shuffle partitions.
    """
    inputs = {name: F.col(f"_in_{name}") for name in values}
    cut = _ranges(df.select("*", *[column.alias(f"_in_{name}") for name, (_, column) in values.items()]), keys, order, pieces)
    last = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_bucket").agg(
        *[_COMBINE[kind][0](inputs[name]).alias(f"_total_{name}") for name, (kind, _) in values.items()]
    )
    carried = totals.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        F.col("_bucket").alias("_of_bucket"),
        *[
            _COMBINE[kind][0](f"_total_{name}").over(before).alias(f"_carried_{name}")
            for name, (kind, _) in values.items()
        ],
    )
    local = cut.select(
        "*",
        *[_COMBINE[kind][0](inputs[name]).over(inside).alias(f"_own_{name}") for name, (kind, _) in values.items()],
    )
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys], F.col("_bucket") == F.col("_of_bucket"))
    return local.join(carried, same).select(
        *df.columns,
        *[
            _COMBINE[kind][1](F.col(f"_carried_{name}"), F.col(f"_own_{name}")).alias(name)
            for name, (kind, _) in values.items()
        ],
    )


def ordinal(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "ordinal", pieces: int | None = None) -> DataFrame:
    """Add a dense 1-based position per key, the skew-safe ``row_number``.

    The ranges are sorted before they are written, and the rows numbered as they are: that is the one
    shuffle of the rows, and no window sees them. ``pieces`` is as in :func:`running`.
    """
    spark = df.sparkSession
    wanted = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(wanted, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", F.monotonically_increasing_id())
    cut = _written(cut, "ranges")
    # The number of a row is that of its range, 33 bits up, plus its place there.
    bucket = F.shiftright("_at", 33)
    runs = cut.groupBy(*[F.col(key).alias(f"_of_{key}") for key in keys], bucket.alias("_of_bucket")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*[f"_of_{key}" for key in keys]).orderBy("_of_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_start")
    # Written, so that its size is known to the join: where keys are few, the rows stay where they are.
    carried = _written(runs.select(*[f"_of_{key}" for key in keys], "_of_bucket", start), "range-starts")
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys], bucket == F.col("_of_bucket"))
    return cut.join(carried, same).select(*df.columns, (F.col("_at") + F.col("_start")).alias(name))


def blocked(df: DataFrame, position: Column, lookback: int, block: int = 65536) -> DataFrame:
    """Cut dense positions into equal blocks with ``lookback`` rows of overlap.

    Adds ``_block`` and ``_own``. Evaluate a window over (keys, ``_block``) that
    looks back at most ``lookback`` rows, then keep the rows where ``_own``.
    Blocks are at least as long as the lookback.
    """
    block = max(block, lookback)
    home = F.floor(position / block)
    near_end = F.pmod(position, F.lit(block)) >= block - lookback
    return (
        df.withColumn("_home", home)
        .withColumn(
            "_block",
            F.explode(F.when(near_end, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array("_home"))),
        )
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )
