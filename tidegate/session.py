"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All date arithmetic of the library assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Temporary folders of local sessions that name none, by application; gone with the process.
_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, read from the session.

    Only a local session may leave it unset and gets a temporary folder that is deleted
    at exit; on a cluster a machine-local path would lose data with the machine, so
    that is an error. The session's settings stay as they are.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = path = tempfile.mkdtemp(prefix="tidegate-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return _LOCAL[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used by another run."""
    return f"{shared_root(spark)}/tidegate/{name}-{uuid.uuid4().hex}"


_STAGED: dict[tuple[str, str, str, tuple], str] = {}


def _files(spark: SparkSession, source: str) -> tuple:
    """Names, sizes and times of the files below a folder, two levels deep; a rewritten table differs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return ()
    found = list(store.listStatus(path))
    found += [inner for status in found if status.isDirectory() for inner in store.listStatus(status.getPath())]
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found))


def staged_path(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> str:
    """A dataset that several queries read, written once per application and state of the source's files."""
    key = (spark.sparkContext.applicationId, name, source, _files(spark, source))
    if key not in _STAGED:
        path = scratch_path(spark, name)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


# What a cluster session should set as well; the write path and the joins rely on adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.speculation": "false",
}


def local_session(cores: str | int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidegate")
        .config("spark.driver.memory", os.environ.get("TIDEGATE_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
