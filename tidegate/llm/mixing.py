"""Mixing sources to target weights, with DataFrame operations only.

Every row gets a hash-random key. Rows are cut into ranges of that key within
their source, the ranges are summed, and a prefix sum over the few ranges of a
source plus one inside a range gives each row the words that lie before it.
A source whose target is above its size is repeated whole, the rest is cut at
the exact budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the key that name a range: 4,096 ranges of a source, about a four-thousandth of it in each.
RANGE_DIGITS = 3


def hash_key(seed: str, *columns: Column) -> Column:
    """A key that looks random, depends on the row alone and agrees between reruns (128 bits as hex)."""
    return F.md5(F.concat_ws("\x1f", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], volume: float, most: float) -> DataFrame:
    """Targets of sources. ``sizes`` has ``source`` and ``source_size``, one row per source.

    Sources by code point, null last, have the weights in turn. Together they get
    ``volume`` times all sizes; a target stops at ``most`` times its source's size
    and what it leaves is shared again by weight. The outcome of that sharing is
    ``min(cap, level * weight)`` for one level, which follows from prefix sums over
    the sources in the order in which they reach their caps. Sources without words get 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    cap = F.col("source_size") * F.lit(float(most))
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    reached = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(volume)))
        .withColumn("level", level)
    )
    # The level is that of the first source, in this order, that stays below its cap; none does if the volume is at least `most`.
    final = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"]
    target = F.when(final.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), final * F.col("weight")))
    return reached.select("source", "source_size", target.alias("target"))


def mix(
    rows: DataFrame,
    size: str,
    source: str,
    key: list[str],
    seed: str = "mix",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    volume: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Adds ``source_size``, ``target``, ``epochs`` (whole takes) and ``part`` (units of the last, partial take).

    ``size`` names a non-negative long without nulls. Null sources are one source of
    their own. ``key`` names the columns that the random order follows; rows equal in
    all of them have the same chance and any of them may be cut, with equal results.
    The units taken of a source add up to its target, rounded down. An empty table
    gives an empty one. Columns of ``rows`` stay; names of the added ones must be free.
    """
    names = rows.columns
    kept = rows.select(F.struct(*names).alias("row"), F.col(source).alias("source"), F.col(size).alias("size"))
    random = hash_key(seed, *(F.col("row")[k] for k in key))
    keyed = kept.withColumn("key", random).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    # Ranges are small; both the sums and the windows below use this one shuffle.
    dealt = keyed.repartition("source", "range")
    ranges = dealt.groupBy("source", "range").agg(F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, volume, most)
    offsets = ranges.withColumn("offset", F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words"))
    about = offsets.join(targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source"))).select(
        F.col("source").alias("in_source"), F.col("range").alias("in_range"), "offset", "source_size", "target"
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        about, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("range") == F.col("in_range"))
    )
    # A target that is whole but for the last bits of a double counts as whole.
    budget = F.floor(F.col("target") + F.lit(1e-6)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("inside")
    return placed.select(
        *(F.col("row")[n].alias(n) for n in names),
        "source_size",
        "target",
        epochs.alias("epochs"),
        F.greatest(F.lit(0), F.least(F.col("size"), rest)).cast("long").alias("part"),
    )


def mixed_rows(mixed: DataFrame, size: str) -> DataFrame:
    """One row for each whole take of a mixed row; the row at the cut counts if at least half of it fits."""
    last = F.when((F.col("part") * 2 >= F.col(size)) & (F.col("part") > 0), 1).otherwise(0)
    added = {"source_size", "target", "epochs", "part"}
    takes = mixed.withColumn("takes", (F.col("epochs") + last).cast("int"))
    return takes.filter("takes > 0").withColumn("take", F.explode(F.sequence(F.lit(1), F.col("takes")))).drop(*added, "takes")
