"""Triggered, incremental sync of a change table into a search index.

An index is a folder of generations; a full refresh starts a new one beside the old. Inside a generation every sync
writes only what changed::

    generation=000000/
        checkpoint/          progress of the stream
        changes/batch=7/     newest row of each key that batch 7 brought, deleted keys as tombstones; none for a first load
        base/batch=5/        all rows up to batch 5, written now and then so that reads stay cheap
        postings/...         the text vectors of each of these folders by dimension, which searches read
        about/               key, text column and dimensions of the vectors

A folder counts once its ``_SUCCESS`` file is there, and a repeated batch overwrites its own folder, so a batch that is
run again after a lost executor or driver leaves the same index.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.config import TOP_K
from papertrove.functions import vectors
from papertrove.operators.search import Keys, posting_hits, question_entries, search_many, stored_keys, write_dimensions
from papertrove.operators.tables import latest_rows
from papertrove.sources.storage import child_names, is_complete, stage

DELETED = "_deleted"
# Folders that the dimensions of a batch's vectors share.
PARTS = 64
# Changed rows kept beside the base, as a share of its rows, before a new base is written.
COMPACT_SHARE = 0.2


@dataclass(frozen=True)
class SyncedIndex:
    """Where an index lives and how its rows are identified."""

    path: str
    key: tuple[str, ...]
    version: tuple[str, ...]
    compact_share: float = COMPACT_SHARE
    parts: int = PARTS

    def _complete(self, folder: str, prefix: str) -> list[int]:
        numbers = [int(n.removeprefix(prefix)) for n in child_names(folder) if n.startswith(prefix)]
        return sorted(n for n in numbers if is_complete(f"{folder}/{prefix}{n}"))

    def _generations(self) -> list[int]:
        names = [n for n in child_names(self.path) if n.startswith("generation=")]
        return sorted(int(n.removeprefix("generation=")) for n in names)

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation:06d}"

    def exists(self) -> bool:
        return self._current() is not None

    def _current(self) -> str | None:
        """The newest generation that has finished its first base."""
        for generation in reversed(self._generations()):
            folder = self._folder(generation)
            if self._complete(f"{folder}/base", "batch="):
                return folder
        return None

    # ------------------------------------------------------------ reading

    def _parts(
        self,
        spark: SparkSession,
        folder: str,
        before: int | None,
        take: Callable[[DataFrame], DataFrame] = lambda stored: stored,
    ) -> tuple[DataFrame | None, DataFrame | None]:
        """Newest base, and the newest change of each key since then; only batches below ``before`` count.

        ``take`` picks columns and keys of what is stored before the changes are reduced, which carries whole rows.
        """
        bases = [n for n in self._complete(f"{folder}/base", "batch=") if before is None or n < before]
        since = bases[-1] if bases else -1
        batches = [n for n in self._complete(f"{folder}/changes", "batch=") if n > since]
        batches = [n for n in batches if before is None or n < before]
        base = take(spark.read.parquet(f"{folder}/base/batch={since}")) if bases else None
        if not batches:
            return base, None
        changes = take(spark.read.parquet(*[f"{folder}/changes/batch={n}" for n in batches]))
        return base, latest_rows(changes, self.key, self.version)

    def _all_rows(self, base: DataFrame | None, changes: DataFrame | None) -> DataFrame | None:
        """Base rows with their changes applied, tombstones included."""
        if base is None or changes is None:
            return base if changes is None else changes
        # Spark sends the keys to the tasks if their measured size allows it.
        return base.join(changes.select(*self.key), list(self.key), "left_anti").unionByName(changes)

    def read(self, spark: SparkSession) -> DataFrame:
        """Live rows of the index."""
        folder = self._current()
        if folder is None:
            raise ValueError(f"there is no index at {self.path}")
        return self._live(*self._parts(spark, folder, None))

    def _live(self, base: DataFrame | None, changes: DataFrame | None) -> DataFrame:
        return self._all_rows(base, changes).where(~F.col(DELETED)).drop(DELETED)

    # ------------------------------------------------------------ searching

    def about(self, spark: SparkSession):
        """How the index was made: ``key, text, dimensions, parts``."""
        folder = self._current()
        if folder is None:
            raise ValueError(f"there is no index at {self.path}")
        return spark.read.parquet(f"{folder}/about").first()

    def search(self, spark: SparkSession, question: str | DataFrame, columns: Sequence[str], k: int = TOP_K) -> DataFrame:
        """The ``k`` live rows most similar to a question that share a token with it, best first: ``columns, score``.

        Only the postings of the question's dimensions are read, from the newest base and the changes since. A hit counts
        if no later batch changed or removed its key, which the keys of the changes alone tell. The rows are fetched last.
        """
        about, folder = self.about(spark), self._current()
        bases = self._complete(f"{folder}/postings/base", "batch=")
        if not bases:
            raise ValueError(f"the index at {self.path} is still being written")
        since = bases[-1]
        batches = [n for n in self._complete(f"{folder}/postings/changes", "batch=") if n > since]
        entries = question_entries(spark, question, about.dimensions)
        keys = list(self.key)
        found = spark.read.parquet(f"{folder}/postings/base/batch={since}")
        hits = posting_hits(found, entries, about.parts, keys)
        if batches:
            changes = [
                spark.read.parquet(f"{folder}/changes/batch={n}").select(*keys, F.lit(n).alias("_batch")) for n in batches
            ]
            newest = functools.reduce(DataFrame.union, changes).groupBy(*keys).agg(F.max("_batch").alias("_batch"))
            hits = hits.join(newest.select(*keys), keys, "left_anti")
            for n in batches:
                own = posting_hits(spark.read.parquet(f"{folder}/postings/changes/batch={n}"), entries, about.parts, keys)
                hits = hits.unionByName(own.join(newest.where(F.col("_batch") == n).select(*keys), keys, "left_semi"))
        best = hits.orderBy(F.desc("score"), *keys).limit(k)
        asked = dict.fromkeys([*keys, *columns])
        stored_columns = dict.fromkeys([*asked, *self.version, DELETED])

        def of_hits(stored: DataFrame) -> DataFrame:
            # There are at most ``k`` of them, so no stored row is shuffled to meet them.
            return stored.select(*stored_columns).join(F.broadcast(best.select(*keys)), keys, "left_semi")

        rows = self._live(*self._parts(spark, folder, None, of_hits)).select(*asked)
        return rows.join(best, keys).orderBy(F.desc("score"), *keys).select(*columns, "score")

    def search_many(self, questions: DataFrame, k: int = TOP_K, question_key: Keys = "question_id", text: str = "text") -> DataFrame:
        """``(query_id, neighbor_id, score, rank)`` of the live rows for every question; nothing about the layout is asked."""
        spark = questions.sparkSession
        dimensions = self.about(spark).dimensions
        asked = questions.withColumn("vector", vectors.hash_embed(F.col(text), dimensions))
        key = self.key[0] if len(self.key) == 1 else list(self.key)
        return search_many(self.read(spark), asked, k, question_key, key, dimensions=dimensions)

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame, folder: str, kind: str, batch_id: int) -> None:
        """Write a batch's rows, and from what was written its postings."""
        spark, place = rows.sparkSession, f"{kind}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(f"{folder}/{place}")
        written = spark.read.schema(rows.schema).parquet(f"{folder}/{place}")
        entries = written.select(*stored_keys(self.key), F.inline("vector"))
        write_dimensions(entries, f"{folder}/postings/{place}", self.parts)

    def _apply(self, folder: str, embed: Callable[[DataFrame], DataFrame], deleted: Column):
        def apply_batch(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            marked = batch.withColumn(DELETED, F.coalesce(deleted, F.lit(False)))
            newest = latest_rows(marked, self.key, self.version)
            versions = dict.fromkeys([*self.key, *self.version, DELETED])
            base, changes = self._parts(spark, folder, batch_id, lambda stored: stored.select(*versions))
            if base is None and changes is None:
                # A first load is the base itself.
                self._write(embed(newest), folder, "base", batch_id)
                return
            newest = stage(newest, "sync-batch")
            for stored in (base, changes):
                if stored is not None:
                    newest = self._newer_than(newest, stored)
            self._write(embed(newest), folder, "changes", batch_id)
            if base is None or self._pending(spark, folder) > self.compact_share * base.count():
                # Vectors are wider than their texts, so they are computed again instead of going through the join.
                rows = self._all_rows(*self._parts(spark, folder, batch_id + 1, lambda stored: stored.drop("vector")))
                self._write(embed(rows), folder, "base", batch_id)

        return apply_batch

    def _pending(self, spark: SparkSession, folder: str) -> int:
        """Rows written as changes since the newest base, from the Parquet footers."""
        since = max(self._complete(f"{folder}/base", "batch="), default=-1)
        batches = [n for n in self._complete(f"{folder}/changes", "batch=") if n > since]
        return spark.read.parquet(*[f"{folder}/changes/batch={n}" for n in batches]).count() if batches else 0

    def _newer_than(self, incoming: DataFrame, stored: DataFrame) -> DataFrame:
        """Drop incoming rows that are not newer than the stored row of their key: late and repeated ones.

        Only keys and versions of the stored rows are read.
        """
        held = stored.select(*self.key, F.struct(*self.version).alias("_held"))
        joined = incoming.join(held, list(self.key), "left")
        return joined.where(F.col("_held").isNull() | (F.struct(*self.version) > F.col("_held"))).drop("_held")

    def sync(
        self,
        source: DataFrame,
        text: str,
        deleted: Column | None = None,
        full_refresh: bool = False,
        dimensions: int = vectors.DIMENSIONS,
    ) -> None:
        """Bring the index up to date with a streaming change table and return when all of it is processed.

        The first call creates the index; later ones read only what was added since. ``deleted`` marks rows that remove
        their key. ``full_refresh`` rebuilds into a new generation while readers stay on the old one until it is done.
        """
        generations = self._generations()
        current = generations[-1] if generations else 0
        folder = self._folder(current + 1 if full_refresh and generations else current)

        def embed(rows: DataFrame) -> DataFrame:
            vector = F.when(~F.col(DELETED), vectors.hash_embed(F.col(text), dimensions))
            return rows.withColumn("vector", vector)

        about = source.sparkSession.createDataFrame(
            [(list(self.key), text, dimensions, self.parts)], "key array<string>, text string, dimensions int, parts int"
        )
        if not is_complete(f"{folder}/about"):
            about.write.mode("overwrite").parquet(f"{folder}/about")
        elif source.sparkSession.read.parquet(f"{folder}/about").first() != about.first():
            raise ValueError("the index was made with another key, text column or layout; use full_refresh")
        query = (
            source.writeStream.foreachBatch(self._apply(folder, embed, F.lit(False) if deleted is None else deleted))
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def change_stream(
    spark: SparkSession, folder: str, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet change files as a stream; files added later belong to the next sync.

    ``glob`` restricts the file names, for folders that hold more than one table.
    """
    sample = spark.read.parquet(folder) if glob is None else spark.read.option("pathGlobFilter", glob).parquet(folder)
    reader = spark.readStream.schema(sample.schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def open_index(path: str, key: str | Sequence[str], version: str | Sequence[str], **options) -> SyncedIndex:
    keys = (key,) if isinstance(key, str) else tuple(key)
    versions = (version,) if isinstance(version, str) else tuple(version)
    return SyncedIndex(path.rstrip("/"), keys, versions, **options)
