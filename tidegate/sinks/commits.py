"""A dataset's commit log: numbered files that are created once and never changed.

Layout: ``<root>/commits/<number>.json``, one entry a file. Whoever commits reads the log up to a number, does the
work, and creates the next number; a number that another run took meanwhile is read and judged first, so of two runs
that began from the same state only one can commit what excludes the other. Everything that a commit changes is in its
entry: which run becomes visible, which runs it replaces, which chunks arrived, and where the checkpoint moves.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.times import epoch_micros

#: Times are epoch seconds, ``committed_at`` microseconds. ``kind``: commit, reset, replace or expire.
ENTRY = (
    "version BIGINT, kind STRING, run_id STRING, checkpoint_key STRING, rows BIGINT, records BIGINT, high_water_mark BIGINT, committed_at BIGINT, "
    "metadata STRING, chunks ARRAY<STRUCT<start_s: BIGINT, end_s: BIGINT, failed: BOOLEAN, records: BIGINT>>, replaces ARRAY<STRING>, expire_before STRING"
)
Entry = dict


class CommitConflict(RuntimeError):
    """Another run committed something that excludes this commit."""


def store(spark: SparkSession, path: str):
    """The Hadoop path and its file system, as the session's settings resolve it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the log in ascending order."""
    path, files = store(spark, f"{root}/commits")
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False if it is there already.

    The content is written under another name first. A local file is then linked to its name, which fails if that is
    taken; other stores rename without overwriting.
    """
    target, files = store(spark, path)
    parent, name = path.rsplit("/", 1)
    draft, _ = store(spark, f"{parent}/_draft-{uuid.uuid4().hex}-{name}")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        mode = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        modes = spark.sparkContext._gateway.new_array(mode, 1)
        modes[0] = mode.NONE
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(draft, target, modes)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(draft, False)


def read_log(spark: SparkSession, root: str, numbers: Iterable[int] | None = None) -> DataFrame:
    """Entries of the log as it is now; a later commit does not change the result."""
    found = versions(spark, root) if numbers is None else sorted(numbers)
    if not found:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json([f"{root}/commits/{n:012d}.json" for n in found])


def append(spark: SparkSession, root: str, entry: Entry, base: int, excludes: Callable[[Entry], bool] = lambda entry: False) -> int:
    """Create the next entry and return its number.

    ``base`` is the last number that the commit rests on. Entries after it are passed to ``excludes``; if one of them
    excludes this commit, nothing is written and :class:`CommitConflict` is raised.
    """
    while True:
        newer = [v for v in versions(spark, root) if v > base]
        for other in read_log(spark, root, newer).collect() if newer else []:
            if excludes(other.asDict(recursive=True)):
                raise CommitConflict(f"{other['kind']} of {other['run_id']} (number {other['version']})")
        base = newer[-1] if newer else base
        number = base + 1
        if create_once(spark, f"{root}/commits/{number:012d}.json", json.dumps(entry | {"version": number})):
            return number


def new_entry(kind: str, run_id: str, at: datetime, **fields) -> Entry:
    return {"kind": kind, "run_id": run_id, "committed_at": epoch_micros(at)} | fields


def committed_runs(log: DataFrame) -> DataFrame:
    """``run_id`` of the runs with a commit; those of a compaction among them."""
    return log.where(F.col("kind").isin("commit", "replace")).select("run_id").distinct()


def replaced_parts(log: DataFrame) -> DataFrame:
    """``part``: folders ``run_id=<run>/dt=<date>`` whose rows a compaction has rewritten."""
    return log.select(F.explode("replaces").alias("part")).distinct()


def first_visible_date(log: DataFrame) -> str | None:
    """Partitions before this date have expired."""
    return log.agg(F.max("expire_before")).first()[0]


def valid_entries(log: DataFrame, key: str | None = None) -> DataFrame:
    """Entries of a checkpoint since its last reset, or of all checkpoints."""
    keyed = log.where(F.col("checkpoint_key").isNotNull() if key is None else F.col("checkpoint_key") == key)
    resets = keyed.where("kind = 'reset'").groupBy(F.col("checkpoint_key").alias("reset_key")).agg(F.max("version").alias("reset_version"))
    joined = keyed.join(resets, F.col("checkpoint_key") == F.col("reset_key"), "left")
    return joined.where("kind <> 'reset' AND (reset_version IS NULL OR version > reset_version)").drop("reset_key", "reset_version")


def chunk_states(log: DataFrame, key: str) -> DataFrame:
    """Chunks that the checkpoint's runs read: ``run_id``, ``version``, ``start_s``, ``end_s``, ``failed``, ``records``."""
    return valid_entries(log, key).select("run_id", "version", F.explode("chunks").alias("chunk")).select("run_id", "version", "chunk.*")
