"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import dealt_anew, written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node of ``links`` (columns ``a``, ``b``; long, not null).

    Alternates between linking all larger neighbours and all neighbours of a node to its smallest one until every node
    hangs on the smallest of its component. The smallest neighbour is found by a pre-aggregated minimum, and a node's
    neighbours are never gathered in one place. Every round is a written table. Its joins are merged: both sides are
    shuffled anyway, and the tables that would be broadcast, several in a round, would add up in the driver.
    """
    current = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    turn = 0
    while not _stars(current):
        turn += 1
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        # A hub has many neighbours; see dealt_anew.
        key = dealt_anew(F.col("a")).alias("key")
        larger = current.select(dealt_anew(F.col("b")).alias("key"), "a")
        large = larger.join(least.select(key, "least").hint("merge"), "key").select("a", F.col("least").alias("b"))
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        # Equal rows go at the end of the round only: a shuffle between the joins would send no fewer.
        small = large.select(key, "a", "b").join(smallest.select(key, "least").hint("merge"), "key").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        current = written(small.filter("a <> b").distinct(), f"{name}-{turn}")
    # Of stars, what others hang on hangs on nothing.
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _stars(links: DataFrame) -> bool:
    """Whether each node hangs on one alone, and that on nothing: then a round would change nothing."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    met = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return met.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").agg(F.count("*")).first()[0] == 0
