"""Where tables are kept that a job writes and reads again: the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a new temporary one if all runs in one process; an error on a cluster."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="dialoom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


_folders: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """Where this application's tables lie. It is deleted when the driver ends: a lazy result may read them until then."""
    folder = f"{shared_root(spark)}/tables-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_clear, spark, folder)
    return folder


def _clear(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session was stopped before
        with suppress(Exception):
            remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class _Scopes(threading.local):
    """Open scopes of this thread, innermost last: paths of tables that go when a scope ends."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread makes within are deleted at the end; what is still needed must be at a path that was named before."""
    own: list[str] = []
    _scopes.open.append(own)
    try:
        yield
    finally:
        _scopes.open.remove(own)
        for path in own:
            remove(spark, path)


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{scratch_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """df as Parquet. The shuffle files of this write go when it ends; else they stay until the driver happens to collect garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)


def checkpointed(df: DataFrame, path: str | None = None) -> DataFrame:
    """df as a table of the shared folder, cut from its lineage. Written once, where DataFrame.checkpoint works its rows out twice."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "step")
    written(df, path)
    return spark.read.schema(df.schema).parquet(path)
