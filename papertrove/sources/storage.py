"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def default_file_system(spark: SparkSession) -> str:
    """The file system that paths without a scheme belong to."""
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"


def open_folder(path: str, default: str = "file:///") -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a path or URI, and the path inside it; for use inside tasks."""
    if path.startswith("/") and not default.startswith("file:"):
        path = default.rstrip("/") + path
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path.removeprefix("file:")


def child_names(path: str) -> list[str]:
    """Names directly under a folder, seen with the session's own file systems; none when there is no such folder."""
    context = SparkSession.active().sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(where) or not files.getFileStatus(where).isDirectory():
        return []
    return [entry.getPath().getName() for entry in files.listStatus(where)]


def is_complete(path: str) -> bool:
    """True when a Spark write into the folder has finished."""
    return "_SUCCESS" in child_names(path)


def newest_commit(folder: str, prefix: str = "commit=") -> int | None:
    """The highest number among the finished ``commit=<n>`` folders under ``folder``; none when there is none."""
    numbers = (int(n.removeprefix(prefix)) for n in child_names(folder) if n.startswith(prefix))
    return next((n for n in sorted(numbers, reverse=True) if is_complete(f"{folder}/{prefix}{n}")), None)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one run under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then uses the machine's own temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="papertrove-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage (a lost executor re-reads files instead of recomputing) and keeps costly or order-dependent
    columns from being evaluated twice.
    """
    folder = work_folder(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
