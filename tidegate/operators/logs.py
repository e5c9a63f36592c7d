"""Reading structured logs: parsing, rates, timing, silence, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegate.functions.times import as_timestamp
from tidegate.operators.ordered import ordinal
from tidegate.operators.validate import parsed_once
from tidegate.schema import LOG_SCHEMA

#: Lines that a task of the operation times sorts, about.
TASK_LINES = 500_000


def parse_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Typed fields of JSON lines; a line that is no JSON keeps its text in ``corrupt``."""
    schema = StructType([*LOG_SCHEMA.fields, StructField("corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    parsed = lines.select(parsed_once(F.from_json(text, schema, options)))
    return parsed.withColumn("ts", F.try_to_timestamp("timestamp"))


def error_lines(log: DataFrame) -> DataFrame:
    return log.where(F.col("level") == "ERROR")


def error_rate(log: DataFrame, by: list[str], limit: float = 0.01) -> DataFrame:
    """(Specified here.) Share of ERROR lines and whether it exceeds ``limit``."""
    errors = F.count_if(F.col("level") == "ERROR")
    return log.groupBy(*by).agg(
        F.count("*").alias("lines"),
        errors.alias("errors"),
        (errors / F.count("*")).alias("error_rate"),
        (errors / F.count("*") > limit).alias("alert"),
    )


def operation_stats(log: DataFrame) -> DataFrame:
    """(Specified here.) Lines and durations per operation, most frequent first."""
    return (
        log.groupBy("operation")
        .agg(
            F.count("*").alias("lines"),
            F.avg("duration_ms").alias("avg_ms"),
            F.max("duration_ms").alias("max_ms"),
        )
        .orderBy(F.desc("lines"), "operation")
    )


def slowest(log: DataFrame, by: str = "partition_id", k: int | None = 10) -> DataFrame:
    """(Specified here.) Longest duration per ``by``, slowest first; a top-k report unless ``k`` is None."""
    ranked = log.groupBy(by).agg(F.max("duration_ms").alias("max_ms")).orderBy(F.desc("max_ms"), by)
    return ranked.limit(k) if k else ranked


def silences(log: DataFrame, ts: str = "ts", by: list[str] | None = None, minutes: int = 15, as_of=None) -> DataFrame:
    """(Specified here.) Gaps of more than ``minutes`` between consecutive lines.

    Two lines in the same slot of that length are never that far apart, so only
    the first and last line of each slot matter: the window sees one row per slot.
    With ``as_of``, a silence that still goes on then is reported as well, with a NULL ``silent_until`` and its length so
    far; lines after ``as_of`` do not count.
    """
    keys, limit = by or [], minutes * 60_000_000
    seen = log if as_of is None else log.where(F.col(ts) <= as_timestamp(as_of))
    slot = F.floor(F.unix_micros(ts) / limit).alias("slot")
    slots = seen.groupBy(*keys, slot).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    previous = F.lag("last_ts").over(Window.partitionBy(*keys).orderBy("slot"))
    gap = F.unix_micros("first_ts") - F.unix_micros("silent_from")
    closed = (
        slots.withColumn("silent_from", previous)
        .where(gap > limit)
        .select(*keys, "silent_from", F.col("first_ts").alias("silent_until"), (gap / 1e6).alias("gap_seconds"))
    )
    if as_of is None:
        return closed
    so_far = F.unix_micros(as_timestamp(as_of)) - F.unix_micros("silent_from")
    last = slots.groupBy(*keys).agg(F.max("last_ts").alias("silent_from")).where(so_far > limit)
    return closed.unionByName(last.select(*keys, "silent_from", F.lit(None).cast("timestamp").alias("silent_until"), (so_far / 1e6).alias("gap_seconds")))


def sample_every(log: DataFrame, n: int = 100, by: str = "operation", order: list[str] | None = None) -> DataFrame:
    """(Specified here.) Every n-th line of each operation in time order."""
    order = order or ["ts"]
    return ordinal(log, [by], order).where(F.col("ordinal") % n == 0).drop("ordinal")


def operation_times(log: DataFrame, order: list[str], pieces: int | None = None) -> DataFrame:
    """Pair 'Starting' lines with the 'Completed' or 'Failed' line that follows in the same run.

    Takes ``job_id``, ``run_id``, ``ts``, ``message`` and the columns of ``order``, which starts with ``ts``.
    Starts of an operation within its run are numbered, so runs of a job that overlap do not mix; a start
    without an end stays 'open'. A NULL job or run is a value of its own. ``pieces`` is the number of tasks,
    by default that of the session's shuffle partitions or one for ``TASK_LINES`` lines, whichever is more: a
    task sorts its lines and holds nothing else, so that its memory does not grow with the log.
    """
    message, run = F.col("message"), ["job_id", "run_id", "operation"]
    lines = log.select(
        "job_id",
        "run_id",
        *[c for c in order if c not in ("job_id", "run_id")],
        F.regexp_extract(message, r"^(?:Starting|Completed|Failed): (.*)$", 1).alias("operation"),
        message.startswith("Starting: ").alias("starts"),
        message.startswith("Failed: ").alias("fails"),
    ).where(F.col("operation") != "")
    wanted = pieces or max(int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-log.count() // TASK_LINES))
    # A run's lines of one operation are few, so a plain window serves.
    place = Window.partitionBy(*run).orderBy(*order)
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts, fails = F.col("starts"), F.col("fails")
    numbered = lines.repartition(wanted, *run).select(
        *run,
        "ts",
        "starts",
        F.sum(starts.cast("bigint")).over(so_far).alias("attempt"),
        F.last(F.when(starts, F.struct("ts")), True).over(so_far)["ts"].alias("started_at"),
        F.last(F.when(starts | fails, fails), True).over(so_far).alias("failed"),
        F.lead("starts").over(place).alias("next_starts"),
    )
    # The last line of an attempt is its latest end, or its start if it has none.
    paired = numbered.where("next_starts IS NULL OR next_starts").withColumn("ended_at", F.when(~starts, F.col("ts")))
    return paired.select(
        *run,
        "attempt",
        "started_at",
        "ended_at",
        F.when(F.col("ended_at").isNull(), "open").when(F.col("failed"), "failed").otherwise("completed").alias("outcome"),
        F.floor((F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1000).alias("duration_ms"),
    )
