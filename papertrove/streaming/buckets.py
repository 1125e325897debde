"""A synced index in hash buckets of its key, with one manifest per commit.

Layout::

    about/                     key, version, text column, numbers of buckets and of posting folders, schema of the rows
    data/commit=7/...          files that commit 7 wrote: changed rows by bucket, rewritten buckets, postings by dimension
    manifests/commit=7/        every live file after commit 7: its kind, bucket or posting folder, commit and rows

A reader takes the newest whole manifest and opens the files it names; folders of data are never listed. A sync opens the
buckets of the keys it brings and no others. A commit that is run again overwrites its own files and starts from the
manifest before it. Rows carry the commit they came with, and so do postings, so a bucket can be rewritten without its
postings: a posting counts while the live row of its key has the same commit.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from papertrove.config import TOP_K
from papertrove.functions import vectors
from papertrove.operators.search import posting_hits, question_entries, stored_keys, write_dimensions
from papertrove.operators.tables import latest_rows
from papertrove.sources.storage import child_names, is_complete, stage

DELETED, COMMIT, BUCKET, KEY, SCORE = "_deleted", "_commit", "_bucket", "_key", "_score"
BASE, CHANGE, POSTINGS, SYNC = "base", "change", "postings", "sync"
# A bucket is rewritten once its changes pass this share of its base; postings are rewritten by the same measure.
COMPACT_SHARE = 0.25
# Commits whose postings, or change files of one bucket, stand side by side before they are put together.
MOST_COMMITS = 8
_MANIFEST = "kind string, slot int, commit long, file string, rows long"


@dataclass(frozen=True)
class BucketedIndex:
    """Where an index lives, how its rows are identified, and into how many buckets and posting folders it is cut."""

    path: str
    key: tuple[str, ...]
    version: tuple[str, ...]
    buckets: int = 64
    parts: int = 64
    compact_share: float = COMPACT_SHARE
    most_commits: int = MOST_COMMITS

    # ------------------------------------------------------------ manifests

    def commits(self) -> list[int]:
        """Commits that have a manifest folder, from one listing."""
        names = child_names(f"{self.path}/manifests")
        return sorted(int(n.removeprefix("commit=")) for n in names if n.startswith("commit="))

    def _manifest(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest whole manifest, of commits below ``before``."""
        for commit in reversed(self.commits()):
            folder = f"{self.path}/manifests/commit={commit}"
            if (before is None or commit < before) and is_complete(folder):
                return spark.read.schema(_MANIFEST).parquet(folder)
        return None

    def exists(self, spark: SparkSession) -> bool:
        return self._manifest(spark) is not None

    def manifest(self, spark: SparkSession) -> DataFrame:
        """``(kind, slot, commit, file, rows)`` of all live files; the row of kind ``sync`` counts the buckets that the
        commit touched (slot) and the files that it opened to apply its changes (rows)."""
        found = self._manifest(spark)
        if found is None:
            raise ValueError(f"there is no index at {self.path}")
        return found

    def about(self, spark: SparkSession) -> Row:
        return spark.read.parquet(f"{self.path}/about").first()

    # ------------------------------------------------------------ rows

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _key(self) -> Column:
        """The key as one value; as a struct it equals itself even where a part of it is null."""
        return F.struct(*self.key)

    def _open(self, spark: SparkSession, schema: StructType, files: Sequence[str]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*files)

    def _rows(self, spark: SparkSession, entries: Sequence[Row], schema: StructType) -> DataFrame:
        """The newest row of every key in the files of some buckets, tombstones included.

        Buckets without changes hold one row per key already and are not shuffled.
        """
        by_bucket: dict[int, list[Row]] = defaultdict(list)
        for entry in entries:
            by_bucket[entry["slot"]].append(entry)
        changed = {slot for slot, held in by_bucket.items() if any(e["kind"] == CHANGE for e in held)}
        whole = self._open(spark, schema, [e["file"] for e in entries if e["slot"] not in changed])
        if not changed:
            return whole
        mixed = self._open(spark, schema, [e["file"] for e in entries if e["slot"] in changed])
        return whole.unionByName(latest_rows(mixed, self.key, self.version))

    def _stored(self, manifest: DataFrame, slots: Sequence[int] | None = None) -> list[Row]:
        """Manifest rows of the data files, of some buckets or of all."""
        rows = manifest.where(F.col("kind").isin(BASE, CHANGE))
        return (rows if slots is None else rows.where(F.col("slot").isin(list(slots)))).collect()

    def read(self, spark: SparkSession) -> DataFrame:
        """Live rows of the index."""
        stored = self._stored(self.manifest(spark))
        rows = self._rows(spark, stored, StructType.fromJson(json.loads(self.about(spark)["schema"])))
        return rows.where(~F.col(DELETED)).drop(DELETED, COMMIT)

    def _fetch(self, spark: SparkSession, keys: DataFrame, schema: StructType) -> DataFrame:
        """Live rows of a few keys: only the files of their buckets are opened."""
        slots = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
        rows = self._rows(spark, self._stored(self.manifest(spark), slots), schema)
        wanted = keys.select(self._key().alias(KEY))
        return rows.where(~F.col(DELETED)).withColumn(KEY, self._key()).join(wanted, KEY, "left_semi")

    # ------------------------------------------------------------ searching

    def search(self, spark: SparkSession, question: str | DataFrame, columns: Sequence[str], k: int = TOP_K) -> DataFrame:
        """The ``k`` live rows most similar to a question that share a token with it, best first: ``columns, score``.

        Postings of the question's dimensions give the best keys with the commit they were posted in; the buckets of
        these keys tell which are live. Should too few be, twice as many are looked at, and so on.
        """
        if "score" in columns:
            raise ValueError("score is the answer's own column; rename that of the index")
        about = self.about(spark)
        schema = StructType.fromJson(json.loads(about["schema"]))
        entries = question_entries(spark, question, about.dimensions)
        folders = sorted({dim % self.parts for dim, _ in entries})
        files = self.manifest(spark).where((F.col("kind") == POSTINGS) & F.col("slot").isin(folders)).collect()
        keys = list(self.key)
        posted = self._open(spark, self._posting_schema(schema), [f["file"] for f in files])
        posted = posted.withColumn("part", F.col("dim") % self.parts)
        hits = posting_hits(posted, entries, self.parts, [*keys, COMMIT]).orderBy(F.desc("score"), *keys)
        wanted = 2 * k
        while True:
            best = hits.limit(wanted).collect()
            scored = spark.createDataFrame(best, hits.schema)
            live = self._fetch(spark, scored.select(*keys).distinct(), schema)
            # The rows may have a column called score as well.
            scored = scored.select(self._key().alias(KEY), COMMIT, F.col("score").alias(SCORE))
            found = live.join(scored, [KEY, COMMIT]).orderBy(F.desc(SCORE), *keys).limit(k)
            if len(best) < wanted or found.count() >= k:
                return found.select(*columns, F.col(SCORE).alias("score"))
            wanted *= 2

    def _posting_schema(self, schema: StructType) -> StructType:
        out = StructType()
        for i, name in enumerate([*self.key, COMMIT]):
            out = out.add(f"key_{i}", schema[name].dataType)
        return out.add("dim", IntegerType()).add("weight", DoubleType())

    # ------------------------------------------------------------ writing

    def _written(self, df: DataFrame, folder: str, slot: str, commit: int, kind: str) -> list[tuple]:
        """Manifest rows of the files in a folder, from their footers; ``slot`` is the column the folder is cut by."""
        spark = df.sparkSession
        rows = spark.read.schema(df.schema).parquet(folder)
        found = rows.groupBy(F.col(slot).alias("slot"), F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
        return [(kind, r["slot"], commit, r["file"], r["rows"]) for r in found.collect()]

    def _write_rows(self, rows: DataFrame, folder: str, commit: int, kind: str) -> list[tuple]:
        cut = rows.withColumn(BUCKET, self._bucket())
        cut.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        return self._written(cut, folder, BUCKET, commit, kind)

    def _write_postings(self, rows: DataFrame, folder: str, commit: int) -> list[tuple]:
        live = rows.where(~F.col(DELETED))
        entries = live.select(*stored_keys([*self.key, COMMIT]), F.inline("vector"))
        write_dimensions(entries, folder, self.parts)
        return self._written(entries.withColumn("part", F.lit(0)), folder, "part", commit, POSTINGS)

    def _apply(self, embed, deleted: Column, about: dict):
        def apply_batch(batch: DataFrame, commit: int) -> None:
            spark, folder = batch.sparkSession, f"{self.path}/data/commit={commit}"
            marked = batch.withColumn(DELETED, F.coalesce(deleted, F.lit(False)))
            newest = stage(latest_rows(marked, self.key, self.version).withColumn(BUCKET, self._bucket()), "bucket-batch")
            touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]
            newest = newest.drop(BUCKET)
            manifest = self._manifest(spark, commit)
            live = [] if manifest is None else [tuple(r) for r in manifest.where(F.col("kind") != SYNC).collect()]
            opened = [Row(kind=e[0], slot=e[1], file=e[3]) for e in live if e[0] != POSTINGS and e[1] in set(touched)]
            accepted = newest
            if opened:
                schema = StructType.fromJson(json.loads(self.about(spark)["schema"]))
                held = self._open(spark, schema, [e["file"] for e in opened])
                held = held.groupBy(self._key().alias(KEY)).agg(F.max(F.struct(*self.version)).alias("_held"))
                joined = newest.withColumn(KEY, self._key()).join(held, KEY, "left")
                newer = F.col("_held").isNull() | (F.struct(*self.version) > F.col("_held"))
                accepted = joined.where(newer).drop(KEY, "_held")
            rows = embed(accepted).withColumn(COMMIT, F.lit(commit).cast("long"))
            if manifest is None:
                made = [(*about.values(), rows.schema.json())]
                names = "key array<string>, version array<string>, text string, dimensions int, buckets int, parts int, schema string"
                spark.createDataFrame(made, names).write.mode("overwrite").parquet(f"{self.path}/about")
            added = self._write_rows(rows, f"{folder}/changes", commit, CHANGE)
            changes = self._open(spark, rows.schema, [a[3] for a in added])
            posted = self._write_postings(changes, f"{folder}/postings", commit)
            based = {e[1] for e in live if e[0] == BASE}
            # The first rows of a bucket are its base.
            live += [(CHANGE if a[1] in based else BASE, *a[1:]) for a in added]
            live = self._compacted_rows(spark, live, folder, commit, rows.schema)
            live = self._compacted_postings(spark, live + posted, folder, commit, rows.schema)
            told = spark.createDataFrame([*live, (SYNC, len(touched), commit, "", len(opened))], _MANIFEST)
            told.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/commit={commit}")
            # Files of this commit that it has itself put together with others; no manifest names them.
            _delete(spark, {a[3] for a in [*added, *posted]} - {e[3] for e in live})

        return apply_batch

    def _compacted_rows(self, spark: SparkSession, live: list[tuple], folder: str, commit: int, schema: StructType) -> list[tuple]:
        """Rewrite the buckets whose changes have grown too many, and those alone."""
        base, changes = defaultdict(int), defaultdict(list)
        for kind, slot, made, _, rows in live:
            if kind == BASE:
                base[slot] += rows
            elif kind == CHANGE:
                changes[slot].append((made, rows))
        full = {
            slot
            for slot, held in changes.items()
            if sum(rows for _, rows in held) > self.compact_share * base[slot] or len({m for m, _ in held}) > self.most_commits
        }
        if not full:
            return live
        entries = [Row(kind=e[0], slot=e[1], file=e[3]) for e in live if e[0] in (BASE, CHANGE) and e[1] in full]
        merged = self._write_rows(self._rows(spark, entries, schema), f"{folder}/merged", commit, BASE)
        return [e for e in live if e[0] == POSTINGS or e[1] not in full] + merged

    def _compacted_postings(self, spark: SparkSession, live: list[tuple], folder: str, commit: int, schema: StructType) -> list[tuple]:
        """Write all postings anew once those of later commits pass their share, or put many small commits together."""
        posted = [e for e in live if e[0] == POSTINGS]
        sizes: dict[int, int] = defaultdict(int)
        for entry in posted:
            sizes[entry[2]] += entry[4]
        if len(sizes) < 2:
            return live
        first = min(sizes)
        later = sum(rows for made, rows in sizes.items() if made != first)
        rest = [e for e in live if e[0] != POSTINGS]
        if later > self.compact_share * sizes[first]:
            entries = [Row(kind=e[0], slot=e[1], file=e[3]) for e in rest]
            return rest + self._write_postings(self._rows(spark, entries, schema), f"{folder}/all-postings", commit)
        if len(sizes) - 1 > self.most_commits:
            small = self._open(spark, self._posting_schema(schema), [e[3] for e in posted if e[2] != first])
            write_dimensions(small, f"{folder}/joined-postings", self.parts)
            joined = self._written(small.withColumn("part", F.lit(0)), f"{folder}/joined-postings", "part", commit, POSTINGS)
            return rest + [e for e in posted if e[2] == first] + joined
        return live

    def sync(self, source: DataFrame, text: str, deleted: Column | None = None, dimensions: int = vectors.DIMENSIONS) -> None:
        """Bring the index up to date with a streaming change table and return when all of it is processed.

        Rows that are not newer than the stored one of their key are dropped; ``deleted`` marks rows that remove theirs.
        """
        about = {"key": list(self.key), "version": list(self.version), "text": text, "dimensions": dimensions,
                 "buckets": self.buckets, "parts": self.parts}
        spark = source.sparkSession
        if self.exists(spark) and [self.about(spark)[name] for name in about] != list(about.values()):
            raise ValueError("the index was made with another key, text column or layout")

        def embed(rows: DataFrame) -> DataFrame:
            return rows.withColumn("vector", F.when(~F.col(DELETED), vectors.hash_embed(F.col(text), dimensions)))

        query = (
            source.writeStream.foreachBatch(self._apply(embed, F.lit(False) if deleted is None else deleted, about))
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def clean_up(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete the files that only manifests before the last ``keep`` name, and those manifests; how many files.

        Which files these are comes from the manifests; readers of the last ``keep`` commits are not disturbed.
        """
        whole = [c for c in self.commits() if is_complete(f"{self.path}/manifests/commit={c}")]
        old, kept = whole[: -max(1, keep)], whole[-max(1, keep) :]
        if not old:
            return 0

        def files(commits: list[int]) -> DataFrame:
            named = spark.read.schema(_MANIFEST).parquet(*[f"{self.path}/manifests/commit={c}" for c in commits])
            return named.where(F.col("kind") != SYNC).select("file").distinct()

        gone = files(old).join(files(kept), "file", "left_anti").collect()
        _delete(spark, [r["file"] for r in gone] + [f"{self.path}/manifests/commit={c}" for c in old])
        return len(gone)


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    context = spark.sparkContext
    for name in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(name)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def open_buckets(path: str, key: str | Sequence[str], version: str | Sequence[str], **options) -> BucketedIndex:
    keys = (key,) if isinstance(key, str) else tuple(key)
    versions = (version,) if isinstance(version, str) else tuple(version)
    return BucketedIndex(path.rstrip("/"), keys, versions, **options)
