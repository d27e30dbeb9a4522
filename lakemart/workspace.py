"""Intermediate tables in the folder that all executors share.

A written table cuts lineage and outlives lost executors.  The folder is the one the cluster names in
``spark.checkpoint.dir``; only a local session without that setting gets a temporary one.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_folder: tempfile.TemporaryDirectory | None = None
_scopes = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data, without a trailing slash."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="lakemart-", ignore_cleanup_errors=True)
    return _local_folder.name


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """``(FileSystem, Path)`` of a path, on whatever storage it lies."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path."""
    fs, jpath = hadoop_path(spark, path)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or a folder; the folders above the target are made."""
    fs, path = hadoop_path(spark, source)
    goal = hadoop_path(spark, target)[1]
    fs.mkdirs(goal.getParent())
    if not fs.rename(path, goal):
        raise OSError(f"could not move {source} to {target}")


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    fs, path = hadoop_path(spark, folder)
    names = (s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else ()
    return sorted(name for name in names if not name.startswith("."))


def complete_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder whose write has ended."""
    return [name for name in file_names(spark, folder) if exists(spark, f"{folder}/{name}/_SUCCESS")]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written aside and renamed, so that it is there as a whole or not at all."""
    fs, target = hadoop_path(spark, path)
    aside = hadoop_path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")[1]
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(aside, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = hadoop_path(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on exit what ``Stored`` wrote inside, in this thread; results that read it must be written by then."""
    outer, _scopes.paths = _open_scope(), []
    try:
        yield
    finally:
        written, _scopes.paths = _scopes.paths, outer
        for path in written:
            delete(spark, path)


def _open_scope() -> list[str] | None:
    """What is to be deleted with the innermost ``scratch`` of this thread, if there is one."""
    return getattr(_scopes, "paths", None)


class Stored:
    """A DataFrame written as Parquet: ``df`` reads it back (column-pruned), ``rows`` is its size."""

    def __init__(self, df: DataFrame, label: str):
        spark = df.sparkSession
        self.path = fresh_path(spark, label)
        if (scope := _open_scope()) is not None:
            scope.append(self.path)
        self.rows = write_counted(df, self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)


def write_counted(df: DataFrame, path: str, mode: str = "error", partition_by: list[str] | None = None, **options: str) -> int:
    """Write Parquet and return the number of rows written, counted in the same pass (I16)."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)
    return seen.get.get("rows", 0)


@contextmanager
def _with_setting(spark: SparkSession, key: str, value: str, default: str | None = None) -> Iterator[None]:
    before = spark.conf.get(key) if default is None else spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement go when it has ended.

    Spark otherwise keeps them until the driver happens to collect garbage, so the disk of a long chain of writes holds
    the shuffles of all of them.
    """
    with _with_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false"):
        yield


@contextmanager
def unsorted_writes(spark: SparkSession, writers: int = 2) -> Iterator[None]:
    """Rows of a few partitions go to open files as they come; Spark otherwise sorts each task's rows by partition first.

    Tasks that meet more than ``writers`` partitions sort the rest, so memory stays bounded.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _with_setting(spark, key, str(max(writers, int(spark.conf.get(key))))):
        yield
