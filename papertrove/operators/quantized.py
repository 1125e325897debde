"""Compressed vectors: product quantisation trained in Spark, lookup tables per query, exact scores for the survivors.

A unit vector is cut into pieces of equal width and every piece is stored as the number of its nearest center, one byte.
A stored vector's approximate score is the sum of the query's products with the centers of its bytes, which is one product
with the centers laid side by side. The best of these scores are made again with the vectors themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.config import TOP_K
from papertrove.operators.sampling import bounded_sample
from papertrove.operators.search import (
    DIGITS,
    EXACT_ROWS,
    SLICE_ROWS,
    Keys,
    _among_first,
    _Best,
    _named,
    _result,
    _unit_rows,
    vector_length,
)
from papertrove.sources.storage import default_file_system, open_folder, stage, work_folder

# Centers of a piece (a code is one byte), and the bounded, hash-chosen sample that they are found on.
CENTERS = 256
FIT_ROWS = 65_536
ROUNDS = 8
# Survivors per answer that are scored exactly.
SURVIVORS = 16
# Queries that a task holds at once, and stored vectors that it reads at once.
QUERY_ROWS = 8_192
CODE_ROWS = 32_768


def pieces_of(rows: np.ndarray, pieces: int) -> np.ndarray:
    """Rows cut into ``pieces`` of one width, the last filled up with zeros: ``(pieces, rows, width)``."""
    width = -(-rows.shape[1] // pieces)
    filled = np.zeros((len(rows), pieces * width))
    filled[:, : rows.shape[1]] = rows
    return filled.reshape(len(rows), pieces, width).transpose(1, 0, 2)


def encode_rows(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest center of every piece: ``(rows, pieces)`` bytes. ``centers`` is ``(pieces, centers, width)``."""
    out = np.empty((len(rows), len(centers)), np.uint8)
    for m, piece in enumerate(pieces_of(rows, len(centers))):
        # The nearest one has the largest product less half of its own square.
        out[:, m] = (piece @ centers[m].T - (centers[m] ** 2).sum(axis=1) / 2).argmax(axis=1)
    return out


def fit_centers(held: DataFrame, keys: list[str], pieces: int, rounds: int = ROUNDS, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Centers by k-means over a sample of at most ``fit_rows`` vectors ``v``.

    Every round is a Spark job: tasks assign their rows and add them up, and only sums per center, whose number is fixed,
    are brought together. A center without rows stays where it is.
    """
    sample = stage(bounded_sample(held, keys, fit_rows).select("v"), "quantise-sample")
    first = sample.orderBy(F.xxhash64("v")).limit(CENTERS).toArrow()
    if not first.num_rows:
        return np.zeros((pieces, 1, 1))
    centers = pieces_of(_unit_rows(first.column("v")), pieces)
    schema = pa.schema([("m", pa.int32()), ("c", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centers), np.zeros(centers.shape[:2], np.int64)
        for batch in batches:
            rows = _unit_rows(batch.column("v"))
            codes = encode_rows(rows, centers)
            for m, piece in enumerate(pieces_of(rows, pieces)):
                np.add.at(sums[m], codes[:, m], piece)
                counts[m] += np.bincount(codes[:, m], minlength=centers.shape[1])
        m, c = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(m.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(counts[m, c]), pa.array(sums[m, c].tolist(), schema[3].type)],
            schema=schema,
        )

    for _ in range(rounds):
        parts = sample.mapInArrow(partial, "m int, c int, n long, sums array<double>")
        total = [F.sum(F.get("sums", F.lit(j))) for j in range(centers.shape[2])]
        added = parts.groupBy("m", "c").agg(F.sum("n").alias("n"), F.array(*total).alias("sums")).toArrow()
        m, c = added.column("m").to_numpy(), added.column("c").to_numpy()
        moved = centers.copy()
        moved[m, c] = np.array(added.column("sums").to_pylist()).reshape(len(m), -1) / added.column("n").to_numpy()[:, None]
        if np.allclose(moved, centers):
            break
        centers = moved
    return centers


def write_codes(vectors: DataFrame, path: str, pieces: int = 16, key: Keys = "vec_id", vector: str = "embedding",
                dimensions: int | None = None, fit_rows: int = FIT_ROWS) -> None:
    """Store every searchable vector as ``pieces`` bytes beside its key, and the centers the bytes stand for."""
    spark = vectors.sparkSession
    dimensions = vector_length(vectors, vector) if dimensions is None else dimensions
    held = _named(vectors, key, vector, "n", dimensions)
    names = [c for c in held.columns if c != "v"]
    centers = fit_centers(held, names, pieces, fit_rows=fit_rows)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = encode_rows(_unit_rows(batch.column("v")), centers)
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(pieces), len(codes), [None, pa.py_buffer(codes.tobytes())])
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, data.cast(pa.binary())], names=[*names, "code"])

    kinds = ", ".join(f"{name} {held.schema[name].dataType.simpleString()}" for name in names)
    held.mapInArrow(encode, f"{kinds}, code binary").write.parquet(f"{path}/codes")
    about = spark.createDataFrame(
        [(pieces, dimensions, f"{kinds}, code binary", [centers.shape[1], centers.shape[2]], centers.ravel().tolist())],
        "pieces int, dimensions int, codes string, shape array<int>, centers array<double>",
    )
    about.write.parquet(f"{path}/about")


def decode_rows(codes: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The centers of every code side by side, in single precision: ``(rows, pieces * width)``."""
    single = centers.astype(np.float32)
    return np.concatenate([single[m][codes[:, m]] for m in range(len(centers))], axis=1)


class _Kept:
    """The best ``k`` approximate scores of some queries, added up from a table of products with all centers per query."""

    def __init__(self, tables: np.ndarray, k: int):
        self.tables, self.k = tables, k
        self.scores = np.full((len(tables), 0), -np.inf, np.float32)
        self.places = np.zeros((len(tables), 0), np.int64)

    def add(self, codes: np.ndarray, start: int) -> None:
        scores = np.zeros((len(self.tables), len(codes)), np.float32)
        for m in range(codes.shape[1]):
            scores += self.tables[:, m][:, codes[:, m]]
        places = np.broadcast_to(np.arange(start, start + len(codes)), scores.shape)
        scores, places = np.hstack([self.scores, scores]), np.hstack([self.places, places])
        if scores.shape[1] > self.k:
            top = np.argpartition(-scores, self.k - 1, axis=1)[:, : self.k]
            scores, places = np.take_along_axis(scores, top, axis=1), np.take_along_axis(places, top, axis=1)
        self.scores, self.places = scores, places


def knn_quantized(spark: SparkSession, path: str, vectors: DataFrame, queries: DataFrame, k: int = TOP_K,
                  query_key: Keys = "vec_id", key: Keys = "vec_id", vector: str = "embedding",
                  survivors: int = SURVIVORS) -> DataFrame:
    """``(query_id, neighbor_id, score, rank)`` as ``knn_exact``, out of stored codes; scores are exact, rows nearly so.

    Tasks hold ``QUERY_ROWS`` queries at a time and read the codes, ``CODE_ROWS`` at a time, and then the vectors of the
    ``survivors * k`` best codes of each query, of which they pass on the best ``k``. Where there are too few queries for
    all tasks, each task reads its share of the codes. ``vectors`` are those that the codes were made of.
    """
    about = spark.read.parquet(f"{path}/about").first()
    centers = np.array(about.centers, np.float64).reshape(about.pieces, *about.shape)
    asked = _named(queries, query_key, vector, "q", about.dimensions)
    codes = spark.read.schema(about.codes).parquet(f"{path}/codes")
    q_names, n_names = [c for c in asked.columns if c != "v"], [c for c in codes.columns if c != "code"]
    folder = work_folder(spark, "quantised-rows")
    codes.join(_named(vectors, key, vector, "n", about.dimensions), n_names).write.parquet(folder)
    asked = stage(asked.dropna(subset=q_names), "quantised-queries")
    tasks = max(1, spark.sparkContext.defaultParallelism)
    shares = max(1, min(tasks, tasks * SLICE_ROWS // max(1, asked.count())))
    asked = asked.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).repartition(tasks)
    default, wide, pieces = default_file_system(spark), survivors * k, about.pieces
    kinds = [(n, asked.schema[n].dataType) for n in q_names] + [(n, codes.schema[n].dataType) for n in n_names]

    def stored(columns: list[str]) -> Iterator[tuple[int, pa.RecordBatch]]:
        """Stored rows and the place of the first, in the same order at every reading."""
        files, inside = open_folder(folder, default)
        first = 0
        for entry in sorted(files.get_file_info(pa.fs.FileSelector(inside)), key=lambda e: e.path):
            if entry.base_name.endswith(".parquet"):
                with files.open_input_file(entry.path) as source:
                    for batch in pq.ParquetFile(source).iter_batches(CODE_ROWS, columns=columns):
                        yield first, batch.select(columns)
                        first += batch.num_rows

    def meet(held: pa.Table, share: int) -> Iterator[pa.RecordBatch]:
        matrix = _unit_rows(held.column("v"))
        best = _Best(pieces_of(matrix, pieces).transpose(1, 0, 2).reshape(len(matrix), -1), wide, digits=None)
        for i, (first, batch) in enumerate(stored(["code"])):
            if i % shares == share and batch.num_rows:
                own = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, pieces)
                kept = _among_first(own, wide, np.zeros(len(own), np.int64))
                decoded = decode_rows(own[kept], centers)
                best.add(decoded, decoded, first + kept)
        rows, column = np.nonzero(best.places >= 0)
        places = best.places[rows, column]
        order = np.argsort(places, kind="stable")
        rows, places = rows[order], places[order]
        scores, found = np.empty(len(rows)), []
        for first, batch in stored([*n_names, "v"]):
            start, end = np.searchsorted(places, [first, first + batch.num_rows])
            if start < end:
                inside, at = np.unique(places[start:end] - first, return_inverse=True)
                taken = batch.take(pa.array(inside))
                exact = _unit_rows(taken.column("v"))
                for i in range(start, end, EXACT_ROWS):
                    stop = min(end, i + EXACT_ROWS)
                    pair = matrix[rows[i:stop]], exact[at[i - start : stop - start]]
                    scores[i:stop] = np.round(np.einsum("ij,ij->i", *pair), DIGITS) + 0.0
                found.append(pa.Table.from_batches([taken.select(n_names)]).take(pa.array(at)))
        if not len(rows):
            return
        # What is as good as the k-th best of its query goes on; ties are cut by key when all tasks are through.
        order = np.lexsort((-scores, rows))
        own = rows[order]
        first = np.searchsorted(own, own)
        last = np.minimum(first + k, np.searchsorted(own, own, side="right")) - 1
        order = order[scores[order] >= scores[order][last]]
        left, right = held.select(q_names).take(pa.array(rows[order])), pa.concat_tables(found).take(pa.array(order))
        yield from pa.table([*left.columns, *right.columns, pa.array(scores[order])], names=[*q_names, *n_names, "score"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = pa.Table.from_batches(waiting)
            for share in pc.unique(block.column("share")).to_pylist():
                yield from meet(block.filter(pc.equal(block.column("share"), share)), share)

        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS)
                if rows + part.num_rows > QUERY_ROWS and waiting:
                    yield from done(waiting)
                    waiting, rows = [], 0
                waiting.append(part)
                rows += part.num_rows
        if waiting:
            yield from done(waiting)

    near = asked.mapInArrow(run, ", ".join(f"{n} {kind.simpleString()}" for n, kind in kinds) + ", score double")
    return _result(near, k, query_key, key)
