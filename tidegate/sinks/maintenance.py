"""Upkeep of a dataset below a commit log: compaction, retention, and the removal of what no reader can see.

Compaction and retention are commits: a reader sees the state before or after, never one between. Files go only in
:func:`vacuum`, after a time in which readers of an older state can finish.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.times import epoch_micros
from tidegate.operators.layout import TARGET_BYTES, data_files
from tidegate.sinks import commits, datasets


def compaction_plan(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """(Specified here.) Which partitions of runs to rewrite together: ``dt``, ``bin``, ``run_id``, ``files``, ``bytes``.

    ``files`` has ``run_id``, ``dt``, ``length``. A run's partition whose files fill less than half of the target on average is
    small. Small ones of a date go into bins of about the target by the running sum of their bytes, largest first; a bin of a
    single file stays as it is. Takes one row per run and date.
    """
    parts = files.groupBy("dt", "run_id").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    small = parts.where(F.col("bytes") / F.col("files") < target / 2)
    before = Window.partitionBy("dt").orderBy(F.desc("bytes"), "run_id").rowsBetween(Window.unboundedPreceding, -1)
    packed = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target))
    whole = Window.partitionBy("dt", "bin")
    return packed.withColumn("_files", F.sum("files").over(whole)).where("_files > 1").select("dt", "bin", "run_id", "files", "bytes")


def visible_files(spark: SparkSession, root: str, log: DataFrame | None = None) -> DataFrame:
    """Data files that a reader opens: ``path``, ``length``, ``run_id`` and the partition columns."""
    return datasets.visible(data_files(spark, f"{root}/data"), commits.read_log(spark, root) if log is None else log)


def compact(spark: SparkSession, root: str, run_id: str, at: datetime, target: int = TARGET_BYTES) -> int:
    """Rewrite the small partitions of visible runs as one run that replaces them; how many partitions went into it.

    Each bin becomes one file. The rows and their values stay the same, but for ``run_id``, which is now that of the
    compaction. If another compaction or a retention commit comes first, :class:`~tidegate.sinks.commits.CommitConflict` is raised
    and nothing changes.
    """
    numbers = commits.versions(spark, root)
    log = commits.read_log(spark, root, numbers)
    plan = compaction_plan(visible_files(spark, root, log), target)
    # One row for each run and date that is rewritten; the log has to name them.
    chosen = plan.select("dt", "bin", "run_id").collect()
    if not chosen:
        return 0
    names = sorted(f"run_id={r['run_id']}/dt={r['dt']:%Y-%m-%d}" for r in chosen)
    bins = spark.createDataFrame(chosen, "dt DATE, bin BIGINT, run_id STRING")
    data = spark.read.option("basePath", f"{root}/data").parquet(*(f"{root}/data/{n}" for n in names))
    packed = data.join(bins, ["dt", "run_id"]).drop("run_id")
    rows = packed.select(*(c for c in packed.columns if c not in ("dt", "bin")), "dt", "bin")
    path = datasets.run_path(root, run_id)
    # One task for each bin, however many rows other bins have; a task writes one file for each of its dates.
    rows.repartition(len({(r["dt"], r["bin"]) for r in chosen}), "dt", "bin").drop("bin").write.mode("overwrite").option("compression", "snappy").partitionBy("dt").parquet(path)

    def excludes(other: commits.Entry) -> bool:
        return other["kind"] == "expire" or bool(set(other["replaces"] or []) & set(names))

    entry = commits.new_entry("replace", run_id, at, rows=0, replaces=names)
    commits.append(spark, root, entry, numbers[-1], excludes)
    return len(names)


def expire(spark: SparkSession, root: str, run_id: str, at: datetime, keep_days: int) -> date:
    """Hide all dates more than ``keep_days`` before ``at`` from readers; the first date that is left."""
    first = (at - timedelta(days=keep_days)).date()
    commits.append(spark, root, commits.new_entry("expire", run_id, at, expire_before=first.isoformat()), 0)
    return first


def vacuum(spark: SparkSession, root: str, at: datetime, grace: timedelta = timedelta(days=1), dry_run: bool = False) -> list[tuple[str, str]]:
    """Remove folders that no reader sees and none saw since ``grace`` ago; their paths and why.

    ``expired``: dates hidden by retention. ``replaced``: partitions that a compaction rewrote. ``uncommitted``: runs
    without a commit entry, by the folder's own time. Works on listings of two levels, runs and dates. Commits younger than
    the grace period are as if they were not there, so a reader that began before them can finish.
    """
    log = commits.read_log(spark, root)
    settled = log.where(F.col("committed_at") <= epoch_micros(at - grace))
    first = commits.first_visible_date(settled)
    replaced = {r["part"] for r in commits.replaced_parts(settled).collect()}
    committed = {r["run_id"] for r in commits.committed_runs(log).collect()}
    found = []
    for run in _folders(spark, f"{root}/data"):
        name = run.getPath().getName()
        if name.removeprefix("run_id=") not in committed:
            if run.getModificationTime() * 1000 <= epoch_micros(at - grace):
                found.append((f"{root}/data/{name}", "uncommitted"))
            continue
        for part in _folders(spark, f"{root}/data/{name}"):
            folder = part.getPath().getName()
            if f"{name}/{folder}" in replaced:
                found.append((f"{root}/data/{name}/{folder}", "replaced"))
            elif first is not None and folder.startswith("dt=") and folder.removeprefix("dt=") < first:
                found.append((f"{root}/data/{name}/{folder}", "expired"))
    if not dry_run:
        for path, _ in found:
            hadoop, store = commits.store(spark, path)
            store.delete(hadoop, True)
    return found


def _folders(spark: SparkSession, path: str) -> list:
    hadoop, store = commits.store(spark, path)
    return [s for s in store.listStatus(hadoop) if s.isDirectory()] if store.exists(hadoop) else []
