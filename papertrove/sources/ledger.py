"""Which files of a folder are new, changed or gone since the last run, without opening any.

Layout: ``files/commit=3/`` holds what commit 3 knew of every file (path, length, modification time, chunks made of it),
``attempts/attempt=5/`` marks a run that began. A run that dies commits nothing, so the next one does its work again under
a higher number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.sources.files import scan_binary, source_path
from papertrove.sources.storage import newest_commit

NEW, CHANGED, REMOVED, SAME = "new", "changed", "removed", "same"
# Tasks per core that a listing is read by.
LISTING_TASKS = 2
_FILES = "path string, source_path string, length long, modified timestamp, chunks long"


@dataclass(frozen=True)
class FileLedger:
    """Where the ledger of a folder lives; one writer at a time."""

    path: str

    def begin(self, spark: SparkSession) -> int:
        """The number of this run, higher than that of every run before it, finished or not."""
        last = newest_commit(f"{self.path}/attempts", "attempt=")
        number = 1 if last is None else last + 1
        spark.range(0).write.mode("overwrite").parquet(f"{self.path}/attempts/attempt={number}")
        return number

    def known(self, spark: SparkSession) -> DataFrame:
        """``(path, source_path, length, modified, chunks)`` of the files as of the newest commit."""
        last = newest_commit(f"{self.path}/files")
        if last is None:
            return spark.createDataFrame([], _FILES)
        return spark.read.schema(_FILES).parquet(f"{self.path}/files/commit={last}")

    def compare(self, spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
        """``(path, source_path, length, modified, change, old_chunks)`` of all files there are or were.

        The listing is all that is read: ``content`` is not asked for, so the scan opens no file. A file counts as
        changed when its length or its modification time differs. The scan has no row for an empty file, so one that was
        emptied counts as removed.
        """
        seen = scan_binary(spark, folder, glob).select(
            "path", source_path("path").alias("source_path"), "length", F.col("modificationTime").alias("modified")
        )
        # A scan of small files has a task for every few of them, which costs more than their names and sizes.
        seen = seen.coalesce(LISTING_TASKS * spark.sparkContext.defaultParallelism)
        old = self.known(spark).select(
            "path", F.col("source_path").alias("old_source"), F.col("length").alias("old_length"),
            F.col("modified").alias("old_modified"), F.col("chunks").alias("old_chunks"),
        )
        same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified"))
        change = (
            F.when(F.col("old_source").isNull(), NEW).when(F.col("source_path").isNull(), REMOVED).when(same, SAME).otherwise(CHANGED)
        )
        return seen.join(old, "path", "full_outer").select(
            "path", F.coalesce("source_path", "old_source").alias("source_path"), "length", "modified",
            change.alias("change"), F.coalesce("old_chunks", F.lit(0)).alias("old_chunks"),
        )

    def commit(self, files: DataFrame) -> None:
        """Make ``(path, source_path, length, modified, chunks)`` what the next run compares with."""
        last = newest_commit(f"{self.path}/files")
        files.write.mode("overwrite").parquet(f"{self.path}/files/commit={0 if last is None else last + 1}")
