"""The extract job: plan what is missing, land, enrich, write, audit, commit.

A run's commit entry holds the states of its chunks and its checkpoint, so data, coverage and checkpoint move in one
step. What a run has to read follows from the entries before it: the gaps that failed chunks left, and what is new.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import new_run_id
from tidegate.functions.times import as_timestamp, epoch_micros
from tidegate.operators import chunks
from tidegate.operators.checkpoints import fold_checkpoints
from tidegate.operators.dedup import CHARGE_ORDER, keep_latest
from tidegate.operators.enrich import enrich_charges
from tidegate.operators.quality import quality_report
from tidegate.plans.run_states import RunState
from tidegate.schema import CHARGE_COLUMNS
from tidegate.session import use_utc
from tidegate.sinks import commits, datasets
from tidegate.sources.paged import register

EXIT_OK, EXIT_QUALITY, EXIT_ERROR = 0, 1, 2
#: Times that a run plans anew after another run committed the same chunks.
ATTEMPTS = 3
HOUR, DAY = 3600, 86400


@dataclass
class ExtractConfig:
    """``source`` holds the options of the ``paged`` source except the range.

    ``start`` and ``end`` name a range to read anew; such a run leaves the checkpoint alone. Chunks are ``chunk_hours`` wide, or
    narrower where the counts of earlier runs let expect more than ``target_records`` in one. ``lease_minutes`` is how long a
    run may be silent before it counts as lost.
    """

    root: str
    checkpoint_key: str
    source: dict[str, str] = field(default_factory=dict)
    as_of: datetime | None = None
    default_days: int = 7
    buffer_minutes: int = 5
    chunk_hours: int = 24
    target_records: int = 10_000
    lease_minutes: int = 60
    dev: bool = False
    dry_run: bool = False
    start: datetime | None = None
    end: datetime | None = None


@dataclass
class ExtractResult:
    """``records`` counts charges that were not stored before, ``rejected`` records that do not fit the schema."""

    exit_code: int
    run_id: str
    reason: str
    records: int = 0
    report: dict = field(default_factory=dict)
    high_water_mark: int | None = None
    failed_chunks: int = 0
    rejected: int = 0


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The runs and resets that checkpoints are folded from (columns of ``RUN_SCHEMA``), out of the commit log."""
    entries = commits.read_log(spark, root).where("checkpoint_key IS NOT NULL")
    return entries.select(
        "checkpoint_key",
        "run_id",
        F.timestamp_seconds("high_water_mark").alias("high_water_mark"),
        "records",
        F.lit(None).cast("string").alias("cursor"),
        F.timestamp_micros("committed_at").alias("updated_at"),
        "metadata",
        (F.col("kind") == "reset").alias("is_reset"),
    )


def read_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    return fold_checkpoints(read_runs(spark, root))


def current_charges(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version of every charge.

    A charge keeps its ``created`` when its status changes, so the run decides first.
    """
    rows = datasets.read_committed(spark, root).drop("run_id")
    return keep_latest(rows, ["id"], ["-processed_at", *CHARGE_ORDER])


def reset_checkpoint(spark: SparkSession, root: str, key: str, reason: str, at: datetime | None = None) -> None:
    """Voids a checkpoint for good: the next run starts as the first one did. The reset stays in the log with its reason."""
    at = at or datetime.now(timezone.utc)
    entry = commits.new_entry("reset", new_run_id(datetime.now(timezone.utc)), at, checkpoint_key=key, metadata=json.dumps({"reset": reason}))
    commits.append(spark, root, entry, 0)


# ---- planning


@dataclass
class Plan:
    """``chunks`` to read, as the log with so many entries wants it; ``end`` is where the checkpoint goes if all arrive."""

    base: int
    chunks: list[tuple[int, int]]
    end: int


def _aligned(second: int, width: int) -> int:
    return second - second % width


def _windows(spark: SparkSession, config: ExtractConfig, now: int, log: DataFrame) -> tuple[list[tuple[int, int]], int]:
    """Ranges to read, and their end. Gaps of earlier runs are read whole; the buffer before the frontier is read again."""
    width = config.chunk_hours * HOUR
    end = now if config.end is None else epoch_micros(config.end) // 1_000_000
    if config.start is not None:
        return [(_aligned(epoch_micros(config.start) // 1_000_000, width), end)], end
    states = commits.chunk_states(log, config.checkpoint_key)
    first, frontier = states.agg(F.min("start_s"), F.max(F.when(~F.col("failed"), F.col("end_s")))).first()
    if frontier is None:
        start = _aligned(now - config.default_days * 86400, width) if first is None else first
        return [(start, end)], end
    gaps = [(r["start_s"], r["end_s"]) for r in chunks.coverage_gaps(states, first, min(frontier, end)).orderBy("start_s").collect()]
    if frontier >= end:
        return gaps, end
    overlap = _aligned(frontier - config.buffer_minutes * 60, width)
    return [(lo, min(hi, overlap)) for lo, hi in gaps if lo < overlap] + [(overlap, end)], end


def _busy_cuts(spark: SparkSession, config: ExtractConfig, log: DataFrame, start: int, end: int) -> list[int]:
    """Places at which chunks are cut finer, from the hourly counts of the checkpoint's earlier runs."""
    states = commits.chunk_states(log, config.checkpoint_key)
    counts = datasets.read_or_empty(spark, f"{config.root}/counts", "hour_s BIGINT, records BIGINT, run_id STRING")
    # Of an hour that several runs read, the last one knows all.
    runs = states.groupBy("run_id").agg(F.max("version").alias("version"))
    last = counts.join(runs, "run_id").groupBy("hour_s").agg(F.max_by("records", "version").alias("records"))
    hours = F.sequence(F.floor(F.col("start_s") / HOUR), F.floor((F.col("end_s") - 1) / HOUR))
    covered = states.where("NOT failed").select(F.explode(hours).alias("hour")).select((F.col("hour") * HOUR).alias("hour_s"))
    lo, hi = (F.timestamp_seconds(F.lit(second)) for second in (_aligned(start, HOUR), end))
    expected = chunks.forecast_counts(last, covered, chunks.plan_chunks(spark, lo, hi, 1))
    wide = F.floor(F.unix_seconds("start_ts") / (config.chunk_hours * HOUR)).alias("wide")
    busy = {r["wide"] for r in expected.groupBy(wide).agg(F.sum("records").alias("records")).where(F.col("records") > config.target_records).collect()}
    if not busy:
        return []
    cuts = chunks.balance_chunks(expected, config.target_records).select(F.unix_seconds("start_ts").alias("cut")).collect()
    return sorted({r["cut"] for r in cuts if r["cut"] // (config.chunk_hours * HOUR) in busy})


def plan_run(spark: SparkSession, config: ExtractConfig, now: int) -> Plan:
    """What a run has to read, in chunks. The driver holds one pair of numbers for each chunk."""
    numbers = commits.versions(spark, config.root)
    log = commits.read_log(spark, config.root, numbers)
    windows, end = _windows(spark, config, now, log)
    windows = [(lo, hi) for lo, hi in windows if lo < hi]
    width, cuts = config.chunk_hours * HOUR, []
    if windows and numbers:
        cuts = _busy_cuts(spark, config, log, windows[0][0], windows[-1][1])
    out = []
    for lo, hi in windows:
        edges = sorted({*range(_aligned(lo, width) + width, hi, width), *(c for c in cuts if lo < c < hi)})
        out += list(zip([lo, *edges], [*edges, hi], strict=True))
    return Plan(numbers[-1] if numbers else 0, out, end)


def _pages(spark: SparkSession, config: ExtractConfig, plan: Plan) -> DataFrame:
    ranges = ",".join(f"{lo}-{hi}" for lo, hi in plan.chunks)
    return register(spark).read.format("paged").options(**({"on_error": "record"} | config.source), ranges=ranges).load()


def _dates(plan: Plan) -> Column:
    """A filter on ``dt`` for the dates of the plan's chunks and the day before and after, which neighbouring chunks may have served."""
    day = lambda second: F.lit(datetime.fromtimestamp(second, timezone.utc).date())
    spans: list[list[int]] = []
    for lo, hi in ((lo - DAY, hi + DAY) for lo, hi in plan.chunks):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    found = F.lit(False)
    for lo, hi in spans:
        found = found | ((F.col("dt") >= day(lo)) & (F.col("dt") <= day(hi)))
    return found


def _fresh(spark: SparkSession, root: str, charges: DataFrame, plan: Plan) -> DataFrame:
    """Charges that are not stored in this form, with ``_is_new`` where the id is not stored at all.

    A charge keeps its ``created``, so only the committed partitions of the plan's dates are read.
    """
    form = F.xxhash64(*CHARGE_COLUMNS)
    try:
        committed = datasets.read_committed(spark, root)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return charges.withColumn("_is_new", F.lit(True))
    stored = committed.where(_dates(plan)).select(F.col("id").alias("_id"), form.alias("_form"))
    per_id = stored.groupBy("_id").agg(F.collect_set("_form").alias("_forms"))
    joined = charges.join(per_id, F.col("id") == F.col("_id"), "left")
    return joined.where(F.col("_id").isNull() | ~F.array_contains("_forms", form)).withColumn("_is_new", F.col("_id").isNull()).drop("_id", "_forms")


def _excludes(config: ExtractConfig, plan: Plan, other: commits.Entry) -> bool:
    """Whether another run's commit makes this one void: a reset of its checkpoint, or chunks of it that arrived there."""
    if other["checkpoint_key"] != config.checkpoint_key:
        return False
    theirs = [(c["start_s"], c["end_s"]) for c in other["chunks"] or [] if not c["failed"]]
    return other["kind"] == "reset" or any(lo < high and low < hi for lo, hi in theirs for low, high in plan.chunks)


def run_extract(spark: SparkSession, config: ExtractConfig) -> ExtractResult:
    """One run. The checkpoint moves only with the commit, and never past a failed chunk.

    Only what is missing is paged: the gaps of failed chunks, what is new, and the buffer before it. Records that do not
    fit the schema go to ``rejects/`` with their reasons and stop nothing. What the overlap with earlier runs repeats is
    neither written nor counted again; a changed charge is written as a new version. If another run of
    the same checkpoint commits one of the chunks first, this run plans anew. Every run leaves its states in ``states/``.
    A dry run reports and writes nothing. Exit codes: 0 done (also without new records), 1 quality gate, 2 nothing usable
    arrived or other runs kept committing the same chunks.
    """
    use_utc(spark)
    now = config.as_of or datetime.now(timezone.utc)
    if config.dry_run:
        return _dry_run(spark, config, now)
    for attempt in range(ATTEMPTS):
        run_id = new_run_id(datetime.now(timezone.utc))
        with RunState(spark, config.root, config.checkpoint_key, run_id, now, config.lease_minutes) as state:
            try:
                result = _attempt(spark, config, now, run_id, state)
            except commits.CommitConflict as conflict:
                result = ExtractResult(EXIT_ERROR, run_id, f"conflict: {conflict}")
            state.end({EXIT_OK: "succeeded", EXIT_QUALITY: "gated"}.get(result.exit_code, "failed"), result.reason, result.records)
        if not result.reason.startswith("conflict"):
            return result
    return result


def _dry_run(spark: SparkSession, config: ExtractConfig, now: datetime) -> ExtractResult:
    run_id, plan = new_run_id(datetime.now(timezone.utc)), plan_run(spark, config, epoch_micros(now) // 1_000_000)
    if not plan.chunks:
        return ExtractResult(EXIT_OK, run_id, "nothing to extract")
    rows = _pages(spark, config, plan).where("_error IS NULL AND _reasons IS NULL").select(*CHARGE_COLUMNS)
    report = quality_report(enrich_charges(rows, as_timestamp(now)), config.dev).first().asDict()
    return ExtractResult(EXIT_OK, run_id, "dry run", report["total_records"], report)


def _chunk_rows(landed: DataFrame, plan: Plan) -> list[dict]:
    """State of each of the plan's chunks; one row a chunk comes to the driver."""
    error = F.max(F.col("_error").isNotNull()).alias("failed")
    seen = {r["_chunk_start"]: r for r in landed.groupBy("_chunk_start").agg(error, F.count_if(F.col("_error").isNull()).alias("records")).collect()}
    states = []
    for lo, hi in plan.chunks:
        row = seen.get(lo)
        states.append({"start_s": lo, "end_s": hi, "failed": bool(row and row["failed"]), "records": row["records"] if row else 0})
    return states


def _attempt(spark: SparkSession, config: ExtractConfig, now: datetime, run_id: str, state: RunState) -> ExtractResult:
    plan = plan_run(spark, config, epoch_micros(now) // 1_000_000)
    if not plan.chunks:
        return ExtractResult(EXIT_OK, run_id, "nothing to extract")
    usable = "_error IS NULL AND _reasons IS NULL"
    # The source is paged once; everything else reads what was landed.
    path, pages = f"{config.root}/raw/run_id={run_id}", _pages(spark, config, plan)
    pages.write.mode("overwrite").parquet(path)
    landed = spark.read.schema(pages.schema).parquet(path)
    state.renew()
    states = _chunk_rows(landed, plan)
    failed = [c["start_s"] for c in states if c["failed"]]
    arrived = landed.agg(F.count_if(F.expr(usable)).alias("usable"), F.count_if(F.col("_reasons").isNotNull()).alias("rejected")).first()
    rejected = arrived["rejected"]
    if rejected:
        rejects = landed.where("_reasons IS NOT NULL").select("_chunk_start", "_page", "_reject", "_reasons")
        rejects.write.mode("overwrite").parquet(f"{config.root}/rejects/run_id={run_id}")
    mark = min(failed) if failed else plan.end
    if not arrived["usable"]:
        return ExtractResult(EXIT_ERROR if failed else EXIT_OK, run_id, "no records", failed_chunks=len(failed), rejected=rejected)

    charges = enrich_charges(landed.where(usable).select(*CHARGE_COLUMNS), as_timestamp(now))
    fresh, wrote = _fresh(spark, config.root, charges, plan), Observation()
    watched = fresh.observe(wrote, F.count(F.lit(1)).alias("rows"), F.count_if("_is_new").alias("new")).drop("_is_new")
    written = datasets.write_run(watched, config.root, run_id)
    hours = landed.where(usable).groupBy((F.floor(F.col("created") / HOUR) * HOUR).alias("hour_s")).agg(F.count("*").alias("records"))
    hours.write.mode("overwrite").parquet(f"{config.root}/counts/run_id={run_id}")
    state.renew()
    # Of an input that turns out empty, the optimizer drops the observation with the plan.
    counts = {"rows": 0, "new": 0} if written.isEmpty() else wrote.get
    expected, new = counts["rows"], counts["new"]
    report: dict = {}
    if expected:
        report = quality_report(written, config.dev).first().asDict()
        check = F.lit(report["quality_check"])
        audit = {row["check"]: row for row in datasets.audit_run(written, expected, ["id"], check).collect()}
        broken = [name for name, row in audit.items() if not row["passed"]]
        if broken:
            code = EXIT_QUALITY if broken == ["quality"] else EXIT_ERROR
            return ExtractResult(code, run_id, f"audit failed: {', '.join(broken)}", new, report, rejected=rejected)
    fields = {"rows": expected, "records": new}
    if config.start is None and config.end is None:
        metadata = {"quality_metrics": report, "output_path": datasets.run_path(config.root, run_id), "rejected": rejected}
        fields |= {"checkpoint_key": config.checkpoint_key, "high_water_mark": mark, "chunks": states, "metadata": json.dumps(metadata)}
        commits.append(spark, config.root, commits.new_entry("commit", run_id, now, **fields), plan.base, lambda other: _excludes(config, plan, other))
    elif expected:
        commits.append(spark, config.root, commits.new_entry("commit", run_id, now, **fields), plan.base)
    return ExtractResult(EXIT_OK, run_id, "committed" if expected else "no new records", new, report, mark, len(failed), rejected)
