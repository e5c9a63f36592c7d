"""Time chunks: planning, coverage and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.times import as_timestamp


def plan_chunks(spark: SparkSession, start, end, hours: int = 24) -> DataFrame:
    """Half-open chunks of ``[start, end)``: ``chunk_no``, ``start_ts``, ``end_ts``.

    The last chunk is clipped to ``end``; no rows when ``start >= end``. Bounds
    are datetimes, ISO texts or columns (such as a scalar subquery).
    """
    step = F.make_dt_interval(hours=F.lit(hours))
    bounds = spark.range(1, numPartitions=1).select(as_timestamp(start).alias("lo"), as_timestamp(end).alias("hi"))
    return (
        bounds.where(F.col("lo") < F.col("hi"))
        .select("hi", F.posexplode(F.sequence("lo", F.greatest("lo", "hi"), step)).alias("pos", "start_ts"))
        .where(F.col("start_ts") < F.col("hi"))
        .select(
            F.col("pos").cast("bigint").alias("chunk_no"),
            "start_ts",
            F.least(F.col("start_ts") + step, F.col("hi")).alias("end_ts"),
        )
    )


def in_range(epoch: Column, start_epoch, end_epoch) -> Column:
    """Rows of the half-open range, on the raw epoch column so that Parquet can skip."""
    return (epoch >= start_epoch) & (epoch < end_epoch)


def chunk_counts(rows: DataFrame, ts: str, plan: DataFrame, start, end, hours: int = 24) -> DataFrame:
    """Records of ``[start, end)`` per planned chunk, zero for empty ones.

    ``start`` and ``end`` are those of the plan. The chunk number is computed from
    the timestamp, which turns the range join into an equi-join against counts
    that are already aggregated.
    """
    inside = rows.where((F.col(ts) >= as_timestamp(start)) & (F.col(ts) < as_timestamp(end)))
    micros = F.unix_micros(F.col(ts)) - F.unix_micros(as_timestamp(start))
    number = F.floor(micros / (hours * 3600 * 1_000_000)).alias("chunk_no")
    counts = inside.groupBy(number).agg(F.count("*").alias("records"))
    return plan.join(counts, "chunk_no", "left").withColumn("records", F.coalesce("records", F.lit(0)))


def balance_chunks(counts: DataFrame, target: int) -> DataFrame:
    """(Specified here.) Chunks of about ``target`` records each, from counted fine chunks.

    A fine chunk above the target is cut into equal time slices, small ones are
    merged. Takes one row per fine chunk, however many records those hold.
    ``group_no`` grows with time; groups that a large slice skips have no number.
    """
    slices = F.greatest(F.lit(1), F.ceil(F.col("records") / target)).cast("bigint")
    lo, width = F.unix_micros("start_ts"), F.unix_micros("end_ts") - F.unix_micros("start_ts")
    i, k = F.col("i"), F.col("k")
    # One row per fine chunk goes through the window; its slices follow by arithmetic.
    before = Window.orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("k", slices).withColumn("before", F.coalesce(F.sum("records").over(before), F.lit(0)))
    cut = placed.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1))).select(
        (lo + F.floor(width * i / k)).alias("lo"),
        (lo + F.floor(width * (i + 1) / k)).alias("hi"),
        (F.col("records") / k).alias("weight"),
        # The small addend keeps a rounding error from splitting off a full chunk's last slice.
        F.floor((F.col("before") + F.col("records") * i / k) / target + 1e-9).alias("g"),
    )
    grouped = cut.groupBy("g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("weight").alias("expected"))
    return grouped.select(
        F.col("g").alias("group_no"), F.timestamp_micros("lo").alias("start_ts"), F.timestamp_micros("hi").alias("end_ts"), "expected"
    )


def missing_chunks(plan: DataFrame, done: DataFrame) -> DataFrame:
    """(Specified here.) Planned chunks without a finished counterpart: what a backfill must read."""
    return plan.join(done.select("start_ts", "end_ts"), ["start_ts", "end_ts"], "left_anti")


def coverage_gaps(states: DataFrame, start_s, end_s) -> DataFrame:
    """(Specified here.) What of ``[start_s, end_s)`` no finished chunk covers: ``start_s``, ``end_s`` in epoch seconds.

    ``states`` has ``start_s``, ``end_s``, ``failed``; chunks may overlap and repeat, and a failed one covers nothing.
    Takes one row per chunk, in one window over those of a single checkpoint.
    """
    spark = states.sparkSession
    lo, hi = F.lit(start_s).cast("bigint"), F.lit(end_s).cast("bigint")
    done = states.where("NOT failed").select(F.greatest("start_s", lo).alias("start_s"), F.least("end_s", hi).alias("end_s")).where("start_s < end_s")
    # Empty chunks at both ends of the range turn its edges into gaps between chunks.
    edges = spark.range(1, numPartitions=1).select(F.explode(F.array(lo, hi)).alias("start_s")).withColumn("end_s", F.col("start_s"))
    before = Window.orderBy("start_s", "end_s").rowsBetween(Window.unboundedPreceding, -1)
    reached = done.unionByName(edges).withColumn("reached", F.max("end_s").over(before))
    return reached.where(F.col("start_s") > F.col("reached")).select(F.col("reached").alias("start_s"), F.col("start_s").alias("end_s"))


def forecast_counts(history: DataFrame, covered: DataFrame, plan: DataFrame) -> DataFrame:
    """(Specified here.) Expected ``records`` of each planned hour: the mean of the same hour of the day so far.

    ``history`` has ``hour_s``, ``records`` (hours without records may be missing), ``covered`` one row ``hour_s`` for each
    hour that was read, and ``plan`` the hours of :func:`plan_chunks`. Hours of the day never read expect nothing.
    """
    of_day = F.pmod(F.floor(F.col("hour_s") / 3600), F.lit(24)).cast("int")
    counts = history.groupBy("hour_s").agg(F.sum("records").alias("records"))
    seen = covered.select("hour_s").distinct().join(counts, "hour_s", "left")
    mean = seen.groupBy(of_day.alias("hour_of_day")).agg((F.sum(F.coalesce("records", F.lit(0))) / F.count("*")).alias("records"))
    return plan.withColumn("hour_of_day", F.hour("start_ts")).join(mean, "hour_of_day", "left").select(
        "chunk_no", "start_ts", "end_ts", F.coalesce("records", F.lit(0.0)).alias("records")
    )


def skewed_chunks(counts: DataFrame, value: str = "records", factor: float = 5.0) -> DataFrame:
    """(Specified here.) Chunks above ``factor`` times the median chunk.

    One row per chunk goes in, so the exact median is cheap.
    """
    median = counts.select(F.expr(f"percentile({value}, 0.5)")).scalar()
    return counts.withColumn("median", median).where(F.col(value) > factor * F.col("median"))
