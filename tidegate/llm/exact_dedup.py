"""Exact dedup by a tree merge of sorted digest runs, with DataFrame operations only.

Every input partition becomes a sorted run of digests, written once, so that texts are read and hashed a single time. Runs
are then merged in rounds as on a hypercube: a run's number has one digit for each round, and in a round the runs that
differ in this digit alone exchange what they hold, each entry going to the run whose digit its digest names. So each
round merges ``FAN`` sorted runs into every run, an equal digest keeps the retained row and the number of copies, and after
the last round a digest is in one place. A text with a third of all rows is down to one entry a run before the first exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import written

#: Runs that are merged into each in a round.
FAN = 16
#: What two texts must have in common: SHA-256, byte length, and a hash of another family as a check on both.
IDENTITY = ["digest", "bytes", "check"]


def rounds_for(partitions: int) -> int:
    """Rounds after which ``FAN ** rounds`` runs are at least as many as the partitions."""
    rounds = 1
    while FAN**rounds < partitions:
        rounds += 1
    return rounds


def sorted_runs(documents: DataFrame, doc_id: str, text: str, normalise: Callable[[Column], Column], runs: int) -> DataFrame:
    """``doc_id``, ``place``, ``run`` and identity of each row; each partition is one sorted run."""
    body = F.coalesce(normalise(F.col(text)), F.lit("")).cast("binary")
    digested = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.octet_length(body).alias("bytes"),
        F.xxhash64(body).alias("check"),
    )
    return digested.sortWithinPartitions("digest")


def _merged(entries: DataFrame, keep: Callable[..., Column], *keys: str) -> DataFrame:
    return entries.groupBy(*keys, *IDENTITY).agg(keep("kept_row").alias("kept_row"), F.sum("copies").alias("copies"))


def exact_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    largest: bool = False,
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of every row.

    Texts are equal when the normalised ones are, a null being empty. Of equal texts the row with the smallest id stays,
    or the largest; a row without an id only if none has one, and of rows with that same id just one. ``text_sha256`` is
    that of the normalised text. An empty table gives an empty one; other columns play no part.
    """
    rounds = rounds_for(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Ids ascend or descend; null is behind them all.
    keep, missing = (F.max, F.col("doc_id").isNotNull()) if largest else (F.min, F.col("doc_id").isNull())
    rows = written(sorted_runs(documents, doc_id, text, normalise, FAN**rounds), "digest-runs")
    entries = rows.select("run", *IDENTITY, F.struct(missing.alias("missing"), "doc_id", "place").alias("kept_row"), F.lit(1).cast("long").alias("copies"))
    runs = _merged(entries, keep, "run")
    for turn in range(rounds):
        digit = F.pmod(F.shiftright("check", 4 * turn), F.lit(FAN)).cast("int")
        held = F.pmod(F.floor(F.col("run") / FAN**turn), F.lit(FAN)).cast("int")
        moved = (F.col("run") + (digit - held) * FAN**turn).cast("int").alias("run")
        runs = _merged(runs.select(moved, *IDENTITY, "kept_row", "copies"), keep, "run")
    # Rows learn of their group by the run that they came from, which spreads a large group over all runs.
    groups = written(runs.filter("copies > 1").select(*IDENTITY, "kept_row", "copies"), "digest-groups")
    reached = rows.select("run", *IDENTITY).distinct().join(groups, IDENTITY)
    of = reached.select("run", *IDENTITY, "kept_row", "copies")
    keep_id = F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("kept_row.doc_id"))
    return rows.join(of, ["run", *IDENTITY], "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (F.col("copies").isNull() | (F.col("kept_row.place") == F.col("place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns. Ids must be unique and not null, or rows that share one stay together."""
    kept = exact_duplicates(documents, doc_id, text, **options).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return documents.join(kept, F.col(doc_id).eqNullSafe(F.col("kept_id")), "left_semi")
