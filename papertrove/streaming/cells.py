"""A vector index in cells that follows a change table: rows come, change and go, and cells are split as they grow.

Layout::

    data/commit=7/cells/       vectors that commit 7 brought, by cell, and marks of keys that left a cell
    data/commit=7/places/      the cell and the version of every key that commit 7 brought, by hash bucket of the key
    centers/commit=7/          centers of cells and of their groups, written when commit 7 changed them
    manifests/commit=7/        every live file after commit 7, as in ``buckets``

A key is live in one cell at most: a key that moves or goes leaves a mark in its old cell, and the newest entry of a key
within a cell counts. A sync opens the places of its keys and the cells that it rewrites or splits; a search opens the
cells it looks into. A commit that is run again overwrites its own files and starts from the manifest before it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from papertrove.config import TOP_K
from papertrove.operators.sampling import bounded_sample
from papertrove.operators.search import (
    MIN_CELLS,
    RECALL,
    RECALL_K,
    RECALL_QUERIES,
    SAMPLE_PER_CELL,
    SAMPLE_ROWS,
    SLICE_ROWS,
    Keys,
    _Cells,
    _distances,
    _k_means,
    _named,
    _places,
    _rank,
    _result,
    _Search,
    _unit_rows,
    _visited,
    _visits,
    searchable,
    vector_length,
)
from papertrove.operators.tables import latest_rows
from papertrove.sources.storage import stage
from papertrove.streaming.buckets import _MANIFEST, COMPACT_SHARE, MOST_COMMITS, SYNC, BucketedIndex, _delete

BASE, CHANGE, PLACES, CENTERS = "cell", "cell-change", "place", "centers"
# A cell is split once it holds this multiple of a cell's fair share of the rows.
SPLIT_SHARE = 2.0
SPLIT_LEAST = 16
# Recall is measured anew once the rows have changed by this share since the last time.
MEASURE_SHARE = 0.25
# Vectors of a cell that its new centers are found on, and rounds of finding them.
SPLIT_ROWS = 1_024
ROUNDS = 6
# Where the center of a cell that was split stays in the numbering: out of reach of every unit vector.
_FAR = 1e6


class _Layout:
    """Centers by cell number, the groups they belong to, and the size at which each cell is tried to be split next."""

    def __init__(self, groups: np.ndarray, group_of: np.ndarray, centers: np.ndarray, least: np.ndarray):
        self.groups, self.group_of, self.centers, self.least = groups, group_of, centers, least

    @property
    def cells(self) -> _Cells:
        return _Cells(self.groups, self.group_of, self.centers)

    def split(self, found: dict[int, np.ndarray], sizes: dict[int, int]) -> _Layout:
        """With new cells in place of some; a cell that gave one center only stays and waits until it has doubled."""
        group_of, centers, least = [*self.group_of], [*self.centers], [*self.least]
        for cell in sorted(found):
            if len(found[cell]) < 2:
                least[cell] = 2 * sizes[cell]
                continue
            group_of += [self.group_of[cell]] * len(found[cell])
            centers += list(found[cell])
            least += [0] * len(found[cell])
            centers[cell] = np.full(self.centers.shape[1], _FAR)
        return _Layout(self.groups, np.array(group_of), np.array(centers), np.array(least))

    def write(self, spark: SparkSession, folder: str) -> None:
        rows = [(i, int(g), c.tolist(), int(n)) for i, (g, c, n) in enumerate(zip(self.group_of, self.centers, self.least))]
        rows += [(-1 - i, i, g.tolist(), 0) for i, g in enumerate(self.groups)]
        spark.createDataFrame(rows, _CENTERS).write.mode("overwrite").parquet(folder)

    @staticmethod
    def read(spark: SparkSession, folder: str) -> _Layout:
        rows = spark.read.schema(_CENTERS).parquet(folder).orderBy("cell").collect()
        groups = np.array([r.center for r in rows if r.cell < 0][::-1])
        own = [r for r in rows if r.cell >= 0]
        return _Layout(groups, np.array([r.grp for r in own]), np.array([r.center for r in own]), np.array([r.least for r in own]))


_CENTERS = "cell int, grp int, center array<double>, least long"


@dataclass(frozen=True)
class LiveCells:
    """Where an index of vectors lives, how its rows are identified and versioned, and when it is rewritten."""

    path: str
    key: tuple[str, ...]
    version: tuple[str, ...]
    vector: str = "embedding"
    buckets: int = 64
    split_share: float = SPLIT_SHARE
    compact_share: float = COMPACT_SHARE
    most_commits: int = MOST_COMMITS
    recall: float = RECALL

    @property
    def _log(self) -> BucketedIndex:
        return BucketedIndex(self.path, self.key, self.version)

    @property
    def _names(self) -> list[str]:
        return [f"n{i}" for i in range(len(self.key))]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """``(kind, slot, commit, file, rows)`` of all live files. The row of kind ``sync`` counts the cells that the commit
        wrote (slot) and the files it opened (rows); that of kind ``centers`` has the cells a search looks into as slot."""
        return self._log.manifest(spark)

    def clean_up(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete what only manifests before the last ``keep`` name; how many files or folders of centers."""
        return self._log.clean_up(spark, keep)

    # ------------------------------------------------------------ rows

    def _open(self, spark: SparkSession, schema: StructType, files: Sequence[str]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*files)

    def _schema(self, spark: SparkSession, live: Sequence[tuple], kinds: Sequence[str]) -> StructType | None:
        file = next((e[3] for e in live if e[0] in kinds), None)
        return None if file is None else spark.read.option("recursiveFileLookup", "true").parquet(file).schema

    def _rows(self, spark: SparkSession, live: Sequence[tuple], cells: set[int] | None = None) -> DataFrame:
        """Live rows of some cells or of all: ``(n..., v, ver, live, commit, cell)``.

        A key that leaves a cell and comes back to it by a split within one commit is live in it.
        """
        named = [e for e in live if e[0] in (BASE, CHANGE) and (cells is None or e[1] in cells)]
        schema = self._schema(spark, live, (BASE, CHANGE))
        if schema is None:
            # No cell holds a row; the places still know the types of the keys.
            places = self._open(spark, self._schema(spark, live, (PLACES,)), [])
            return places.selectExpr(*self._names, "cast(null as array<double>) v", "ver", "true live", "commit", "home cell")
        changed = {e[1] for e in named if e[0] == CHANGE}
        whole = self._open(spark, schema, [e[3] for e in named if e[1] not in changed])
        if changed:
            mixed = self._open(spark, schema, [e[3] for e in named if e[1] in changed])
            whole = whole.unionByName(latest_rows(mixed, ["cell", *self._names], ["commit", "live"]))
        return whole.where("live")

    def read(self, spark: SparkSession) -> DataFrame:
        """Keys, cells and vectors of all live rows."""
        rows = self._rows(spark, [tuple(r) for r in self.manifest(spark).collect()])
        return rows.select(*[F.col(n).alias(k) for n, k in zip(self._names, self.key)], "cell", F.col("v").alias(self.vector))

    # ------------------------------------------------------------ searching

    def search(self, spark: SparkSession, queries: DataFrame, k: int = TOP_K, probes: int | None = None,
               query_key: Keys = "vec_id", vector: str = "embedding") -> DataFrame:
        """``(query_id, neighbor_id, score, rank)`` as ``knn_exact``, from the ``probes`` nearest cells of every query (by
        default what the index needs for its recall) and from further ones while a query has fewer than ``k`` rows.
        With as many probes as there are cells the rows are those of ``knn_exact``."""
        live = [tuple(r) for r in self.manifest(spark).collect()]
        told = next(e for e in live if e[0] == CENTERS)
        layout = _Layout.read(spark, told[3])
        centers, seen = layout.centers, told[1] if probes is None else probes
        dimensions = centers.shape[1]
        search = _Search(k, _unit_rows, 8 * max(1, dimensions), None, None)
        asked = stage(_named(queries, query_key, vector, "q", dimensions), "cell-queries")
        q_names = [c for c in asked.columns if c != "v"]

        def look_into(visits: DataFrame, found: DataFrame | None = None) -> DataFrame:
            held = self._rows(spark, live, set(_visited(visits))).select(*self._names, "v", "cell")
            new = search.scan(visits, held, by="cell")
            return stage(_rank(new if found is None else found.drop("rank").unionByName(new), k), "cell-found")

        found = look_into(stage(_visits(asked, centers, lambda d, batch: _places(d) < seen), "cell-visits"))
        while seen < len(centers):
            full = found.where(F.col("rank") == k).select(F.struct(*q_names).alias("_full"))
            waiting = asked.join(full, F.struct(*q_names) == F.col("_full"), "left_anti")
            low, seen = seen, 2 * seen
            more = _visits(waiting, centers, lambda d, batch, low=low, high=seen: (_places(d) >= low) & (_places(d) < high))
            more = stage(more, "cell-visits")
            if more.isEmpty():
                break
            found = look_into(more, found)
        return _result(found.drop("rank"), k, query_key, self.key[0] if len(self.key) == 1 else list(self.key))

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame, folder: str, slot: str, commit: int, kind: str) -> list[tuple]:
        """Manifest rows of the files that ``rows`` are written to, cut by ``slot``; rows counted from the footers."""
        rows.withColumn("slot", F.col(slot)).hint("rebalance", "slot").write.mode("overwrite").partitionBy("slot").parquet(folder)
        back = rows.sparkSession.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(folder)
        counted = back.groupBy(F.col(slot).alias("slot"), F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
        return [(kind, r["slot"], commit, r["file"], r["rows"]) for r in counted.collect()]

    def _placed(self, rows: DataFrame, layout: _Layout) -> DataFrame:
        """Rows with the nearest cell of the nearest group as ``cell``."""
        sent = rows.sparkSession.sparkContext.broadcast(layout.cells)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    cell, _ = sent.value.of(_unit_rows(part.column("v")))
                    columns = [*part.columns, pa.array(cell.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "cell"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(place, f"{kinds}, cell int")

    def _sampled(self, rows: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors and cells of a bounded sample."""
        size = max(SAMPLE_ROWS, SAMPLE_PER_CELL * cells)
        sample = bounded_sample(rows, self._names, size).select("v", "cell").toArrow()
        return _unit_rows(sample.column("v")), sample.column("cell").to_numpy()

    def _probes(self, rows: DataFrame, layout: _Layout) -> int:
        """Cells to look into so that sampled queries find the index's share of their nearest sampled vectors where they
        really lie."""
        points, cell = self._sampled(rows, len(layout.centers))
        if not len(points):
            return 1
        asked = points[:RECALL_QUERIES]
        near = np.argsort(-(asked @ points.T), axis=1, kind="stable")[:, : min(RECALL_K, len(points))]
        needed = np.sort(np.take_along_axis(_places(_distances(asked, layout.centers)), cell[near], axis=1).ravel()) + 1
        return int(needed[int(np.ceil(self.recall * len(needed))) - 1])

    def _first_layout(self, rows: DataFrame) -> _Layout:
        dimensions = vector_length(rows, "v")
        good = rows.where(searchable(F.col("v"), dimensions)).withColumn("cell", F.lit(0))
        cells = max(MIN_CELLS, int(good.count() ** 0.5 / 2))
        points, _ = self._sampled(good, cells)
        if not len(points):
            points = np.zeros((1, max(1, dimensions)))
        found = _Cells.found_on(points, cells, 42, ROUNDS)
        return _Layout(found.groups, found.group_of, found.centers, np.zeros(len(found.centers), np.int64))

    def _apply(self, deleted: Column):
        names = self._names

        def apply_batch(batch: DataFrame, commit: int) -> None:
            spark, folder = batch.sparkSession, f"{self.path}/data/commit={commit}"
            rows = batch.select(
                *[F.col(c).alias(n) for n, c in zip(names, self.key)],
                F.struct(*self.version).alias("ver"),
                F.coalesce(deleted, F.lit(False)).alias("gone"),
                F.col(self.vector).cast("array<double>").alias("v"),
            )
            bucket = F.pmod(F.xxhash64(*names), F.lit(self.buckets)).cast("int")
            newest = stage(latest_rows(rows, names, ["ver"]).withColumn("bucket", bucket), "cell-batch")
            manifest = self._log._manifest(spark, commit)
            live = [] if manifest is None else [tuple(r) for r in manifest.where(F.col("kind") != SYNC).collect()]
            told = next((e for e in live if e[0] == CENTERS), None)
            if not any(e[0] == BASE for e in live):
                told = None
            layout = self._first_layout(newest.where(~F.col("gone"))) if told is None else _Layout.read(spark, told[3])
            touched = {r[0] for r in newest.select("bucket").distinct().collect()}
            opened = [e for e in live if e[0] == PLACES and e[1] in touched]
            accepted = self._accepted(newest, opened)
            good = ~F.col("gone") & searchable(F.col("v"), layout.centers.shape[1])
            stays = self._placed(accepted.where(good), layout)
            goes = accepted.where(~F.coalesce(good, F.lit(False))).withColumn("cell", F.lit(None).cast("int"))
            changes = stage(stays.unionByName(goes), "cell-changes").withColumn("commit", F.lit(commit).cast("long"))
            arrived = changes.where(F.col("cell").isNotNull())
            arrived = arrived.select(*names, "v", "ver", F.lit(True).alias("live"), "commit", "cell")
            left = changes.where(F.col("home").isNotNull() & ~F.col("home").eqNullSafe(F.col("cell")))
            nothing = F.lit(None).cast("array<double>").alias("v")
            left = left.select(*names, nothing, "ver", F.lit(False).alias("live"), "commit", F.col("home").alias("cell"))
            added = self._write(arrived.unionByName(left), f"{folder}/cells", "cell", commit, CHANGE)
            based = {e[1] for e in live if e[0] == BASE}
            added = [(CHANGE if a[1] in based else BASE, *a[1:]) for a in added]
            places = changes.select(*names, "ver", F.col("cell").alias("home"), "commit", F.lit(0).alias("step"), "bucket")
            added += self._write(places, f"{folder}/places", "bucket", commit, PLACES)
            live = [e for e in live if e[0] != CENTERS] + added
            live, more, layout, split = self._split(spark, live, folder, commit, layout)
            live, again, read = self._compacted(spark, live, folder, commit)
            total = sum(e[4] for e in live if e[0] == BASE)
            if told is None or split or abs(total - told[4]) > MEASURE_SHARE * told[4]:
                where = f"{self.path}/centers/commit={commit}"
                layout.write(spark, where)
                told = (CENTERS, self._probes(self._rows(spark, live), layout), commit, where, total)
            written = len({a[1] for a in [*added, *more, *again] if a[0] in (BASE, CHANGE)})
            sync = (SYNC, written, commit, "", len(opened) + read)
            spark.createDataFrame([*live, told, sync], _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/manifests/commit={commit}"
            )
            _delete(spark, {a[3] for a in [*added, *more, *again]} - {e[3] for e in live})

        return apply_batch

    def _accepted(self, newest: DataFrame, opened: Sequence[tuple]) -> DataFrame:
        """Rows newer than what their key has, with the cell that it lies in as ``home``."""
        if not opened:
            return newest.withColumn("home", F.lit(None).cast("int"))
        spark, names = newest.sparkSession, self._names
        held = self._open(spark, self._schema(spark, opened, (PLACES,)), [e[3] for e in opened])
        held = held.groupBy(F.struct(*names).alias("_key")).agg(
            F.max_by(F.struct(F.col("ver").alias("held"), "home"), F.struct("commit", "step")).alias("_place")
        )
        joined = newest.withColumn("_key", F.struct(*names)).join(held, "_key", "left")
        newer = F.col("_place").isNull() | (F.col("ver") > F.col("_place.held"))
        return joined.where(newer).select(*newest.columns, F.col("_place.home").alias("home"))

    def _split(self, spark: SparkSession, live: list[tuple], folder: str, commit: int, layout: _Layout):
        """Split the cells that hold too many rows: new centers, their rows written to the new cells, keys told."""
        sizes: dict[int, int] = defaultdict(int)
        for kind, slot, _, _, rows in live:
            if kind in (BASE, CHANGE):
                sizes[slot] += rows
        total, names = sum(sizes.values()), self._names
        fair = total / max(MIN_CELLS, int(total**0.5 / 2))
        wide = {c: max(2, round(n / fair)) for c, n in sizes.items() if n > max(self.split_share * fair, SPLIT_LEAST) and n >= layout.least[c]}
        if not wide:
            return live, [], layout, False
        rows = self._rows(spark, live, set(wide))
        some = rows.withColumn("_n", F.row_number().over(W.partitionBy("cell").orderBy(F.xxhash64(*names), *names)))
        some = some.where(F.col("_n") <= SPLIT_ROWS).select("cell", "v")

        def find(part: pa.Table) -> pa.Table:
            cell = part.column("cell")[0].as_py()
            found = _k_means(_unit_rows(part.column("v")), wide[cell], np.random.default_rng(cell), ROUNDS)
            return pa.table({"cell": pa.array([cell], pa.int32()), "centers": pa.array([found.tolist()])})

        told = some.groupBy("cell").applyInArrow(find, "cell int, centers array<array<double>>").collect()
        found = {r["cell"]: np.array(r["centers"]) for r in told}
        layout = layout.split(found, sizes)
        parted = {cell for cell, centers in found.items() if len(centers) > 1}
        if not parted:
            return live, [], layout, True
        moved = self._rows(spark, live, parted).drop("cell").withColumn("commit", F.lit(commit).cast("long"))
        moved = stage(self._placed(moved, layout), "cell-split")
        # A vector on the border may be nearer to a neighbor's center than to the new ones; it is added there.
        homes = [(int(c),) for c in {e[1] for e in live if e[0] == BASE} - parted]
        old = spark.createDataFrame(homes, "cell int")
        added = self._write(moved.join(old, "cell", "left_anti").select(*moved.columns), f"{folder}/split", "cell", commit, BASE)
        added += self._write(moved.join(old, "cell", "left_semi").select(*moved.columns), f"{folder}/split-near", "cell", commit, CHANGE)
        bucket = F.pmod(F.xxhash64(*names), F.lit(self.buckets)).cast("int")
        places = moved.select(*names, "ver", F.col("cell").alias("home"), "commit", F.lit(1).alias("step"), bucket.alias("bucket"))
        added += self._write(places, f"{folder}/split-places", "bucket", commit, PLACES)
        return [e for e in live if e[0] not in (BASE, CHANGE) or e[1] not in parted] + added, added, layout, True

    def _compacted(self, spark: SparkSession, live: list[tuple], folder: str, commit: int):
        """Rewrite the cells and the buckets of places whose changes have grown too many, and those alone."""
        base, changed, commits = defaultdict(int), defaultdict(int), defaultdict(set)
        for kind, slot, made, _, rows in live:
            if kind == BASE:
                base[slot] += rows
            elif kind in (CHANGE, PLACES):
                changed[kind, slot] += rows
                commits[kind, slot].add(made)
        cells = {
            slot
            for (kind, slot), rows in changed.items()
            if kind == CHANGE and (rows > self.compact_share * base[slot] or len(commits[kind, slot]) > self.most_commits)
        }
        added, read = [], 0
        if cells:
            read += sum(e[0] in (BASE, CHANGE) and e[1] in cells for e in live)
            added += self._write(self._rows(spark, live, cells), f"{folder}/merged", "cell", commit, BASE)
            live = [e for e in live if e[0] not in (BASE, CHANGE) or e[1] not in cells]
        full = {slot for (kind, slot), made in commits.items() if kind == PLACES and len(made) > self.most_commits}
        if full:
            files = [e for e in live if e[0] == PLACES and e[1] in full]
            read += len(files)
            held = self._open(spark, self._schema(spark, files, (PLACES,)), [e[3] for e in files])
            added += self._write(latest_rows(held, self._names, ["commit", "step"]), f"{folder}/all-places", "bucket", commit, PLACES)
            live = [e for e in live if e not in set(files)]
        return live + added, added, read

    def sync(self, source: DataFrame, deleted: Column | None = None) -> None:
        """Bring the index up to date with a streaming change table and return when all of it is processed.

        Rows that are not newer than what is known of their key are dropped; ``deleted`` marks rows that remove theirs.
        A key whose vector cannot be searched (null, other length, null or not finite elements) is not found any more.
        """
        query = (
            source.writeStream.foreachBatch(self._apply(F.lit(False) if deleted is None else deleted))
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def open_cells(path: str, key: str | Sequence[str], version: str | Sequence[str], **options) -> LiveCells:
    keys = (key,) if isinstance(key, str) else tuple(key)
    versions = (version,) if isinstance(version, str) else tuple(version)
    return LiveCells(path.rstrip("/"), keys, versions, **options)
