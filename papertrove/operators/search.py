"""Top-k similarity search: one question, many vectors, exact and by cells."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papertrove.config import TOP_K
from papertrove.functions import vectors
from papertrove.operators.names import private
from papertrove.operators.sampling import bounded_sample
from papertrove.sources.storage import default_file_system, open_folder, stage, work_folder

# Scores are compared after rounding to this many digits; equal scores are ordered by key.
DIGITS = 6
# Bytes, as doubles, of the queries and of the vectors that a task holds at once, and the rows it multiplies at once.
QUERY_BLOCK_BYTES = 32 << 20
VECTOR_BLOCK_BYTES = 64 << 20
SLICE_ROWS = 1_024
BLOCK_SLICE_ROWS = 2_048
# Pairs whose products are made in double precision at once, dimensions that one scan of postings asks for, and the length
# above which no product is made in single precision.
EXACT_ROWS = 65_536
SCAN_DIMENSIONS = 16
_SINGLE = 1e15
# Cells are found on a sample of this many vectors, or of so many per cell if that is more.
MIN_CELLS = 16
SAMPLE_ROWS = 20_000
SAMPLE_PER_CELL = 32
# The number of cells a query looks into is the smallest that finds this share of the neighbors of sampled queries.
RECALL = 0.98
RECALL_QUERIES = 256
RECALL_K = 10

Keys = str | Sequence[str]


# ---------------------------------------------------------------- text questions


def embed_text(rows: DataFrame, text: str, name: str = "vector", dimensions: int = vectors.DIMENSIONS) -> DataFrame:
    """Add the hashed text vector of a column; the same function serves index rows and questions."""
    return rows.withColumn(name, vectors.hash_embed(F.col(text), dimensions))


def vector_entries(rows: DataFrame, text: str, keep: Sequence[str | Column], dimensions: int = vectors.DIMENSIONS) -> DataFrame:
    """Long form of the text vectors: ``(keep, dim, weight)``.

    The vector is handed to the generator as an expression. From a column of its own Spark would infer a filter on that
    column's size, push it down to the scan and compute every vector three times.
    """
    return rows.select(*keep, F.inline(vectors.hash_embed(F.col(text), dimensions)))


def similarity_search(
    index: DataFrame,
    question: str | DataFrame,
    columns: Sequence[str],
    k: int = TOP_K,
    key: str | Sequence[str] = "id",
    vector: str = "vector",
    dimensions: int = vectors.DIMENSIONS,
) -> DataFrame:
    """The ``k`` rows of ``index`` most similar to a question, best first: ``columns`` in that order and ``score``.

    ``question`` is a text or a DataFrame of one row and one text column. Its vector reaches the scan as a scalar
    value of fixed size, every row is scored where it lies, and each task keeps its best ``k``: no join and no shuffle
    of the index.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if "score" in [*columns, *keys]:
        raise ValueError("score is the answer's own column; rename that of the index")
    if isinstance(question, str):
        question = index.sparkSession.createDataFrame([(question,)], "text string")
    asked = vectors.hash_embed(F.col(question.columns[0]), dimensions)
    asked = question.select(asked.alias("v")).select(vectors.dense(F.col("v"), dimensions).alias("q"))
    beside = private("asked")
    score = F.round(vectors.sparse_dot(F.col(vector), F.col(beside)), DIGITS)
    wanted = list(dict.fromkeys([*columns, *keys]))
    scored = index.withColumn(beside, asked.scalar()).select(*wanted, score.alias("score"))
    return scored.orderBy(F.desc("score"), *keys).limit(k).select(*columns, "score")


def result_rows(results: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Answers as positional text arrays in the requested column order, with the score beside them."""
    return results.select(F.array(*[F.col(c).cast("string") for c in columns]).alias("row"), "score")


def field_at(row: Column, position: int) -> Column:
    """Field of a positional row, counted from 0."""
    return F.get(row, F.lit(position))


def write_postings(
    rows: DataFrame,
    text: str,
    keys: Sequence[str],
    path: str,
    parts: int = 64,
    dimensions: int = vectors.DIMENSIONS,
) -> None:
    """Store the text vectors by dimension, so that a question only reads the dimensions it has.

    Dimensions share ``parts`` folders, a number that should grow with the data, and are sorted inside each file. The
    rows are rebalanced, not just partitioned, by folder: adaptive execution cuts a folder that holds a dimension most
    rows have into files of even size. How the index was made is kept beside it, so a reader needs nothing but the path.
    """
    write_dimensions(vector_entries(rows, text, stored_keys(keys), dimensions), f"{path}/postings", parts)
    about = rows.sparkSession.createDataFrame(
        [(parts, dimensions, list(keys))], "parts int, dimensions int, keys array<string>"
    )
    about.write.parquet(f"{path}/about")


def stored_keys(keys: Sequence[str]) -> list[Column]:
    """Key columns under the names they have in postings, where no other column can have the same one."""
    return [F.col(name).alias(f"key_{i}") for i, name in enumerate(keys)]


def write_dimensions(entries: DataFrame, path: str, parts: int) -> None:
    """Store ``(key_0, ..., dim, weight)`` rows by dimension in ``parts`` folders."""
    placed = entries.withColumn("part", F.col("dim") % parts)
    keys = [c for c in entries.columns if c.startswith("key_")]
    ordered = placed.hint("rebalance", "part").sortWithinPartitions("part", "dim", *keys)
    ordered.write.mode("overwrite").partitionBy("part").parquet(path)


def question_entries(spark: SparkSession, question: str | DataFrame, dimensions: int) -> list[tuple[int, float]]:
    """Dimension and weight of a question's tokens, at most one per dimension."""
    if isinstance(question, str):
        question = spark.createDataFrame([(question,)], "text string")
    asked = question.select(vectors.hash_embed(F.col(question.columns[0]), dimensions).alias("v")).first().v
    return [(e.dim, e.weight) for e in asked]


def weight_of(dim: Column, weights: dict[int, float]) -> Column:
    """The weight of a dimension, 0 without one: a constant array that is looked into by place."""
    if not weights:
        return F.lit(0.0)
    dense = ",".join(repr(float(weights.get(d, 0.0))) for d in range(max(weights) + 1))
    return F.coalesce(F.get(F.split(F.lit(dense), ",").cast("array<double>"), dim), F.lit(0.0))


def open_dimensions(postings: DataFrame, wanted: dict[int, Column], parts: int) -> DataFrame:
    """Rows of stored postings that meet the condition of their dimension.

    The scan opens only the folders of the dimensions, and each condition is one of its own, which row groups are tested
    against one by one (a list of more than ten values would only be tested by its range). Every ``SCAN_DIMENSIONS`` have
    a scan of their own, neighbors in the folders: a long chain of conditions makes a method too long to be compiled.
    """
    dims = sorted(wanted, key=lambda dim: (dim % parts, dim))
    scans = []
    for at in range(0, len(dims), SCAN_DIMENSIONS):
        some = dims[at : at + SCAN_DIMENSIONS]
        one_of = functools.reduce(Column.__or__, [wanted[dim] for dim in some])
        scans.append(postings.where(F.col("part").isin(sorted({dim % parts for dim in some})) & one_of))
    return functools.reduce(DataFrame.union, scans) if scans else postings.where(F.lit(False))


def posting_hits(postings: DataFrame, entries: list[tuple[int, float]], parts: int, keys: Sequence[str]) -> DataFrame:
    """``(keys, score)`` of the rows of stored postings that share a dimension with the entries.

    The entries become literals. Products are summed per key before the shuffle.
    """
    hits = open_dimensions(postings, {dim: F.col("dim") == dim for dim, _ in entries}, parts)
    weight = weight_of(F.col("dim"), dict(entries))
    named = [F.col(f"key_{i}").alias(name) for i, name in enumerate(keys)]
    return hits.groupBy(*named).agg(F.round(F.sum(F.col("weight") * weight), DIGITS).alias("score"))


def search_postings(spark: SparkSession, path: str, question: str | DataFrame, k: int = TOP_K) -> DataFrame:
    """``(keys, score)`` of the ``k`` best rows that share a token with the question, read from stored postings.

    Same scores as ``similarity_search``; rows that share no token are not returned.
    """
    about = spark.read.parquet(f"{path}/about").first()
    entries = question_entries(spark, question, about.dimensions)
    scored = posting_hits(spark.read.parquet(f"{path}/postings"), entries, about.parts, about["keys"])
    return scored.orderBy(F.desc("score"), *about["keys"]).limit(k)


def search_many(
    index: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    question_key: Keys = "question_id",
    key: Keys = "id",
    vector: str = "vector",
    dimensions: int = vectors.DIMENSIONS,
    query_block: int | None = None,
    vector_block: int | None = None,
) -> DataFrame:
    """Batch form: ``(query_id, neighbor_id, score, rank)`` for every question, in one pass over the index.

    Joining on words would meet every row at the common ones. Instead the questions are read by the tasks that hold the
    rows, block by block. Keys of several columns come back as structs.
    """
    search = _Search(k, lambda column: _dense_rows(column, dimensions), 8 * dimensions, query_block, vector_block)
    asked = _with_keys(questions, question_key, "q").withColumn("v", F.col(vector))
    held = _with_keys(index, key, "n").withColumn("v", F.col(vector))
    found = search.scan(_parts(asked, "q", "v"), _parts(held, "n", "v"))
    return _result(found, k, question_key, key)


# ---------------------------------------------------------------- dense vectors


def searchable(vector: Column, dimensions: int) -> Column:
    """True for a vector of this length whose elements are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def vector_length(rows: DataFrame, vector: str) -> int:
    """The most common length of the vectors (of equally common ones the largest); 0 without vectors."""
    lengths = rows.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("n")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    return first.n if first else 0


def unsearchable(rows: DataFrame, key: Keys, vector: str, dimensions: int | None = None) -> DataFrame:
    """The keys of the rows that no search returns, each with its ``reason``."""
    dimensions = vector_length(rows, vector) if dimensions is None else dimensions
    v = F.col(vector)
    reason = (
        F.when(v.isNull(), "no vector")
        .when(F.size(v) != dimensions, "other length")
        .when(F.exists(v, lambda x: x.isNull()), "null element")
        .otherwise("not finite")
    )
    names = [key] if isinstance(key, str) else list(key)
    return rows.where(~searchable(v, dimensions)).select(*names, reason.alias("reason"))


def _with_keys(df: DataFrame, key: Keys, prefix: str) -> DataFrame:
    names = [key] if isinstance(key, str) else list(key)
    return df.withColumns({f"{prefix}{i}": F.col(name) for i, name in enumerate(names)})


def _parts(df: DataFrame, prefix: str, *others: str) -> DataFrame:
    names = [c for c in df.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    return df.select(*names, *others)


def _named(df: DataFrame, key: Keys, vector: str, prefix: str, dimensions: int) -> DataFrame:
    """Keys as ``<prefix>0, <prefix>1, ...`` and the vector as ``v``, of the rows that can be searched."""
    names = [key] if isinstance(key, str) else list(key)
    kept = df.where(searchable(F.col(vector), dimensions))
    return kept.select(*[F.col(n).alias(f"{prefix}{i}") for i, n in enumerate(names)], F.col(vector).alias("v"))


def _one_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _unit_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Arrow list column, of vectors of one length, to a matrix of unit rows; zero vectors stay zero."""
    array = _one_array(column)
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 1)
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


def _dense_rows(column: pa.ChunkedArray | pa.Array, dimensions: int) -> np.ndarray:
    """Sparse Arrow vectors to a matrix with one column per dimension; null vectors are zero."""
    array = _one_array(column)
    lengths = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    dims, weights = (f.to_numpy(zero_copy_only=False) for f in array.flatten().flatten())
    matrix = np.zeros((len(array), dimensions))
    matrix[np.repeat(np.arange(len(array)), lengths), dims] = weights
    return matrix


class _Best:
    """The best ``k`` (score, place) of each query over the blocks seen so far; ties go to the smaller place.

    Products are made in single precision, and only those that could still be among the best are made again in double
    precision and rounded. With ``digits`` none the single products are the scores.
    """

    def __init__(self, queries: np.ndarray, k: int, digits: int | None = DIGITS, slice_rows: int = SLICE_ROWS):
        self.queries, self.k, self.digits, self.slice_rows = queries, k, digits, slice_rows
        self.longest = _longest(queries)
        self.single = queries.astype(np.float32) if self.longest < _SINGLE else queries
        self.scores = np.full((len(queries), k), -np.inf)
        self.places = np.full((len(queries), k), -1, np.int64)

    def add(self, block: np.ndarray, single: np.ndarray, places: np.ndarray, some: np.ndarray | None = None) -> None:
        """``block`` has rows, ``single`` the same in single precision and ``places`` their places; ``some`` are the
        queries that they meet, by default all."""
        if not len(block):
            return
        asked = np.arange(len(self.queries)) if some is None else some
        # The most that single precision and the rounding can change in a product.
        slack = 0.0
        if self.digits is not None:
            slack = (block.shape[1] + 8) * 2.0**-23 * self.longest * _longest(block) + 10.0**-self.digits
        for q in range(0, len(asked), self.slice_rows):
            rows = asked[q : q + self.slice_rows]
            left = self.single[rows[0] : rows[-1] + 1] if rows[-1] - rows[0] + 1 == len(rows) else self.single[rows]
            for v in range(0, len(block), BLOCK_SLICE_ROWS):
                right = single[v : v + BLOCK_SLICE_ROWS]
                products = left @ right.T
                least = self.scores[rows, -1] - slack
                new = np.flatnonzero(np.isneginf(least))
                if len(new) and len(right) > self.k:
                    # At least k products of this slice are as good as its k-th best.
                    part = products if len(new) == len(rows) else products[new]
                    least[new] = np.partition(part, len(right) - self.k, axis=1)[:, len(right) - self.k] - 2 * slack
                least = np.nextafter(least.astype(products.dtype), products.dtype.type(-np.inf))
                at, column = np.divmod(np.flatnonzero(products >= least[:, None]), len(right))
                if not len(at):
                    continue
                if self.digits is None:
                    scores = products[at, column].astype(np.float64)
                else:
                    scores = np.empty(len(at))
                    for i in range(0, len(at), EXACT_ROWS):
                        pair = self.queries[rows[at[i : i + EXACT_ROWS]]], block[v + column[i : i + EXACT_ROWS]]
                        scores[i : i + EXACT_ROWS] = np.round(np.einsum("ij,ij->i", *pair), self.digits) + 0.0
                self._merge(rows[at], places[v + column], scores)

    def _merge(self, rows: np.ndarray, places: np.ndarray, scores: np.ndarray) -> None:
        touched, own = np.unique(rows, return_inverse=True)
        owner = np.concatenate([np.repeat(np.arange(len(touched)), self.k), own])
        places = np.concatenate([self.places[touched].ravel(), places])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        order = np.lexsort((places, -scores, owner))
        owner = owner[order]
        order = order[np.arange(len(order)) - np.searchsorted(owner, np.arange(len(touched)))[owner] < self.k]
        self.places[touched], self.scores[touched] = places[order].reshape(-1, self.k), scores[order].reshape(-1, self.k)

    def table(self, query_keys: pa.Table, keys: pa.Table) -> pa.Table:
        """The found pairs; ``keys`` has one row per place."""
        rows, column = np.nonzero(self.places >= 0)
        left, right = query_keys.take(pa.array(rows)), keys.take(pa.array(self.places[rows, column]))
        columns = dict(zip(left.column_names, left.columns)) | dict(zip(right.column_names, right.columns))
        return pa.table(columns | {"score": self.scores[rows, column]})


def _longest(rows: np.ndarray) -> float:
    return float(np.sqrt(np.fmax.reduce((rows * rows).sum(axis=1), initial=0.0)))


def _among_first(matrix: np.ndarray, k: int, groups: np.ndarray) -> np.ndarray:
    """Rows that fewer than ``k`` equal rows of their group stand before; the others can be in no top-k."""
    if not matrix.size:
        return np.arange(len(matrix))
    whole = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.shape[1] * matrix.itemsize))).ravel()
    # Equal rows have neighboring ranks, in the order of their places.
    rank = np.empty(len(whole), np.int64)
    rank[np.argsort(whole, kind="stable")] = np.arange(len(whole))
    order = np.lexsort((rank, groups))
    other = np.append(True, (whole[order[1:]] != whole[order[:-1]]) | (groups[order[1:]] != groups[order[:-1]]))
    start = np.flatnonzero(other)[np.cumsum(other) - 1]
    return np.sort(order[np.arange(len(order)) - start < k])


class _Search:
    """Scores rows where they lie against queries that tasks read block by block from a shared folder."""

    def __init__(self, k: int, matrix_of: Callable, row_bytes: int, query_block: int | None, vector_block: int | None):
        self.k, self.matrix_of = k, matrix_of
        self.query_block = query_block or max(1, QUERY_BLOCK_BYTES // row_bytes)
        self.vector_block = vector_block or max(1, VECTOR_BLOCK_BYTES // row_bytes)
        # Every block that a task holds gives k rows a query, so blocks to multiply, which may be small, are held together.
        self.held_rows = max(self.vector_block, VECTOR_BLOCK_BYTES // row_bytes, 1)

    def scan(self, asked: DataFrame, held: DataFrame, by: str | None = None) -> DataFrame:
        """At most ``k`` rows ``(q..., n..., score)`` per query, ``VECTOR_BLOCK_BYTES`` of rows and task.

        The queries are written once; a task reads them a block at a time for the rows it holds, so neither their number
        nor that of the rows changes how the search runs, and no row is shuffled. With ``by`` the rows have a number in
        this column and the queries one bit per number: a row only meets the queries whose bit is set.
        """
        spark = asked.sparkSession
        folder = work_folder(spark, "queries")
        asked.write.parquet(folder)
        default, k, matrix_of = default_file_system(spark), self.k, self.matrix_of
        query_block, vector_block, held_rows = self.query_block, self.vector_block, self.held_rows
        q_names = [c for c in asked.columns if c not in ("v", by)]
        n_names = [c for c in held.columns if c not in ("v", by)]

        def query_tables() -> Iterator[pa.Table]:
            files, inside = open_folder(folder, default)
            for entry in sorted(files.get_file_info(pa.fs.FileSelector(inside, allow_not_found=True)), key=lambda e: e.path):
                if entry.base_name.endswith(".parquet"):
                    with files.open_input_file(entry.path) as source:
                        for batch in pq.ParquetFile(source).iter_batches(query_block):
                            yield pa.Table.from_batches([batch])

        def meet(block: pa.Table) -> Iterator[pa.RecordBatch]:
            order = [(name, "ascending") for name in ([by] if by else []) + n_names]
            block = block.take(pc.sort_indices(block, order))
            matrix = matrix_of(block.column("v"))
            group = np.zeros(len(matrix), np.int64) if by is None else block.column(by).to_numpy()
            kept = _among_first(matrix, k, group)
            keys, matrix, group = block.select(n_names).take(pa.array(kept)), matrix[kept], group[kept]
            single = matrix.astype(np.float32) if _longest(matrix) < _SINGLE else matrix
            values, starts = np.unique(group, return_index=True)
            ends = list(zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(matrix)]))
            # Places follow the keys alone.
            in_order = pc.sort_indices(keys, [(name, "ascending") for name in n_names]).to_numpy()
            place = np.empty(len(matrix), np.int64)
            place[in_order] = np.arange(len(matrix))
            keys = keys.take(pa.array(in_order))
            for queries in query_tables():
                wanted = None if by is None else _marked(queries.column(by))
                if wanted is not None and not wanted[[v for v, _, _ in ends]].any():
                    continue
                best = _Best(matrix_of(queries.column("v")), k)
                for value, start, end in ends:
                    some = None if wanted is None else np.flatnonzero(wanted[value])
                    if some is None or len(some):
                        for v in range(start, end, vector_block):
                            stop = min(end, v + vector_block)
                            best.add(matrix[v:stop], single[v:stop], place[v:stop], some)
                yield from best.table(queries.select(q_names), keys).to_batches()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting: list[pa.RecordBatch] = []
            size = 0
            for batch in batches:
                for at in range(0, batch.num_rows, held_rows):
                    part = batch.slice(at, held_rows)
                    if size + part.num_rows > held_rows and waiting:
                        yield from meet(pa.Table.from_batches(waiting))
                        waiting, size = [], 0
                    waiting.append(part)
                    size += part.num_rows
            if waiting:
                yield from meet(pa.Table.from_batches(waiting))

        kinds = [(n, asked.schema[n].dataType) for n in q_names] + [(n, held.schema[n].dataType) for n in n_names]
        return held.mapInArrow(run, ", ".join(f"{n} {kind.simpleString()}" for n, kind in kinds) + ", score double")


def _marks(chosen: np.ndarray) -> pa.Array:
    """Rows of booleans as one binary value each, a bit per column."""
    return pa.array([row.tobytes() for row in np.packbits(chosen, axis=1)], pa.binary())


def _marked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The columns of ``_marks`` as rows, filled up to whole bytes."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.ascontiguousarray(np.unpackbits(rows, axis=1).view(bool).T)


def _rank(candidates: DataFrame, k: int) -> DataFrame:
    """Cut to ``k`` per query; Spark makes this cut in every task before it shuffles as well."""
    columns = candidates.columns
    best_first = W.partitionBy(*[c for c in columns if c.startswith("q")]).orderBy(
        F.desc("score"), *[c for c in columns if c.startswith("n")]
    )
    return candidates.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def _result(candidates: DataFrame, k: int, query_key: Keys, vector_key: Keys) -> DataFrame:
    """Ranked rows under their public names; a key of several columns is a struct of them."""

    def named(key: Keys, prefix: str) -> Column:
        if isinstance(key, str):
            return F.col(f"{prefix}0")
        return F.struct(*[F.col(f"{prefix}{i}").alias(name) for i, name in enumerate(key)])

    ranked = _rank(candidates, k)
    return ranked.select(named(query_key, "q").alias("query_id"), named(vector_key, "n").alias("neighbor_id"), "score", "rank")


def knn_exact(
    queries: DataFrame,
    vectors_: DataFrame,
    k: int = TOP_K,
    query_key: Keys = "vec_id",
    vector_key: Keys = "vec_id",
    vector: str = "embedding",
    dimensions: int | None = None,
    query_block: int | None = None,
    vector_block: int | None = None,
) -> DataFrame:
    """``(query_id, neighbor_id, score, rank)``: the ``k`` vectors with the highest cosine for every query.

    The vectors are scanned where they lie and read the queries block by block, whatever the number of either. Vectors
    of another length than ``dimensions`` (by default the most common one) and those that are null or hold nulls, NaN or
    infinite values are neither asked nor found; ``unsearchable`` lists them.
    """
    dimensions = vector_length(vectors_, vector) if dimensions is None else dimensions
    search = _Search(k, _unit_rows, 8 * max(1, dimensions), query_block, vector_block)
    asked = _named(queries, query_key, vector, "q", dimensions)
    held = _named(vectors_, vector_key, vector, "n", dimensions)
    return _result(search.scan(asked, held), k, query_key, vector_key)


def knn_blocked(queries: DataFrame, vectors_: DataFrame, query_block: int, vector_block: int, **options) -> DataFrame:
    """``knn_exact`` with blocks of given numbers of rows that are multiplied at once, for machines with less or more
    memory. A task keeps the best of all blocks of the rows it holds, ``VECTOR_BLOCK_BYTES`` at least."""
    return knn_exact(queries, vectors_, query_block=query_block, vector_block=vector_block, **options)


# ---------------------------------------------------------------- cells


def _k_means(points: np.ndarray, cells: int, random: np.random.Generator, rounds: int) -> np.ndarray:
    """Centers of at most ``cells`` groups of the points."""
    distinct = np.unique(points, axis=0)
    centers = distinct[random.permutation(len(distinct))[:cells]]
    for _ in range(rounds):
        nearest = _distances(points, centers).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    squared = (rows * rows).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2.0 * rows @ centers.T
    return np.sqrt(np.maximum(squared, 0.0))


class _Cells:
    """Centers on two levels: a vector belongs to the nearest cell of the nearest group of cells."""

    def __init__(self, groups: np.ndarray, group_of: np.ndarray, centers: np.ndarray):
        self.groups, self.group_of, self.centers = groups, group_of, centers

    @staticmethod
    def found_on(points: np.ndarray, cells: int, seed: int, rounds: int) -> _Cells:
        random = np.random.default_rng(seed)
        groups = _k_means(points, max(1, round(cells**0.5)), random, rounds)
        nearest = _distances(points, groups).argmin(axis=1)
        centers, group_of = [], []
        for group in range(len(groups)):
            own = points[nearest == group]
            share = max(1, round(cells * len(own) / len(points)))
            found = _k_means(own, share, random, rounds) if len(own) else groups[group : group + 1]
            centers.append(found)
            group_of += [group] * len(found)
        return _Cells(groups, np.array(group_of), np.concatenate(centers))

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every row and the distance to its center."""
        cell, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        nearest = _distances(rows, self.groups).argmin(axis=1) if len(rows) else cell
        for group in np.unique(nearest):
            some, own = np.flatnonzero(nearest == group), np.flatnonzero(self.group_of == group)
            apart = _distances(rows[some], self.centers[own])
            best = apart.argmin(axis=1)
            cell[some], distance[some] = own[best], apart[np.arange(len(some)), best]
        return cell, distance


def _probes_for(cells: _Cells, points: np.ndarray, recall: float) -> int:
    """Cells to look into so that sampled queries find the given share of their nearest sampled points."""
    queries = points[: min(len(points), RECALL_QUERIES)]
    near = np.argsort(-(queries @ points.T), axis=1, kind="stable")[:, : min(RECALL_K, len(points))]
    cell, _ = cells.of(points)
    order = np.argsort(_distances(queries, cells.centers), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.take_along_axis(rank, cell[near], axis=1).ravel() + 1
    return int(np.sort(needed)[int(np.ceil(recall * len(needed))) - 1])


def write_cells(
    vectors_: DataFrame,
    path: str,
    cells: int | None = None,
    vector_key: Keys = "vec_id",
    vector: str = "embedding",
    dimensions: int | None = None,
    recall: float = RECALL,
    seed: int = 42,
    rounds: int = 6,
) -> None:
    """Store vectors by cell: grouped around two levels of k-means centers, a folder per cell, with its size and radius.

    The number of ``cells`` grows with the square root of the rows unless it is given. Centers, and the number of cells a
    query has to look into for ``recall``, come from a sample of ``SAMPLE_ROWS`` vectors (``SAMPLE_PER_CELL`` per cell if
    that is more); every searchable vector is stored, copies included.
    """
    spark = vectors_.sparkSession
    dimensions = vector_length(vectors_, vector) if dimensions is None else dimensions
    kept = _named(vectors_, vector_key, vector, "n", dimensions)
    if cells is None:
        cells = max(MIN_CELLS, int(kept.count() ** 0.5 / 2))
    keys = [c for c in kept.columns if c != "v"]
    chosen = bounded_sample(kept, keys, max(SAMPLE_ROWS, SAMPLE_PER_CELL * cells))
    points = _unit_rows(chosen.select("v").toArrow().column("v"))
    if not len(points):
        points = np.zeros((1, max(1, dimensions)))
    found = _Cells.found_on(points, cells, seed, rounds)
    sent = spark.sparkContext.broadcast(found)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                cell, distance = sent.value.of(_unit_rows(part.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(distance)],
                    names=[*part.schema.names, "cell", "distance"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    placed = kept.mapInArrow(place, f"{kinds}, cell int, distance double")
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/vectors")
    sizes = spark.read.schema(f"{kinds}, distance double, cell int").parquet(f"{path}/vectors")
    sizes = sizes.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    rows = [(i, c.tolist()) for i, c in enumerate(found.centers)]
    spark.createDataFrame(rows, "cell int, center array<double>").join(sizes, "cell", "left").write.parquet(f"{path}/cells")
    names = [vector_key] if isinstance(vector_key, str) else list(vector_key)
    about = [(names, kinds, dimensions, _probes_for(found, points, recall))]
    spark.createDataFrame(about, "keys array<string>, kinds string, dimensions int, probes int").write.parquet(f"{path}/about")


def _visits(asked: DataFrame, centers: np.ndarray, choose: Callable) -> DataFrame:
    """Queries with a bit for every cell that ``choose(distances, batch)`` marks, ``(q..., v, cell)``; none without any."""
    sent = asked.sparkSession.sparkContext.broadcast(centers)
    names = [c for c in asked.columns if c.startswith("q")] + ["v"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                chosen = choose(_distances(_unit_rows(part.column("v")), sent.value), part)
                rows = np.flatnonzero(chosen.any(axis=1))
                taken = part.select(names).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*taken.columns, _marks(chosen[rows])], names=[*names, "cell"])

    kinds = ", ".join(f"{n} {asked.schema[n].dataType.simpleString()}" for n in names)
    return asked.mapInArrow(visit, f"{kinds}, cell binary")


def _visited(visits: DataFrame) -> list[int]:
    """The cells that any query looks into."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.flatnonzero(_marked(batch.column("cell")).any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32))], names=["cell"])

    return [r.cell for r in visits.select("cell").mapInArrow(cells, "cell int").distinct().collect()]


def _places(distances: np.ndarray) -> np.ndarray:
    """Place of every cell in the row's order by distance; equal distances go to the lower cell."""
    order = np.argsort(distances, axis=1, kind="stable")
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.arange(order.shape[1])[None, :], axis=1)
    return places


def search_cells(
    queries: DataFrame,
    path: str,
    k: int = TOP_K,
    probes: int | None = None,
    exact: bool = False,
    query_key: Keys = "vec_id",
    vector: str = "embedding",
    query_block: int | None = None,
    vector_block: int | None = None,
) -> DataFrame:
    """Top-k from vectors stored by cell: a query looks into its ``probes`` nearest cells (by default what the index
    needs for its recall), and into further ones while it has fewer than ``k`` vectors.

    With ``exact`` it also looks into every cell that could still hold a better vector (distance to its center minus the
    cell's radius is within the k-th best distance): the nearest of them first, as many as before, and then again with
    what is known by then, until there is none. This gives the rows of ``knn_exact``. Where vectors have no clusters the
    bound excludes nothing, and an exact search is a scan. Only the folders of visited cells are read.
    """
    spark = queries.sparkSession
    about = spark.read.parquet(f"{path}/about").first()
    held = spark.read.schema(f"{about.kinds}, distance double, cell int").parquet(f"{path}/vectors").drop("distance")
    layout = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    centers = np.array([r.center for r in layout])
    # A cell without vectors is out of reach of every query.
    radii = np.array([-10.0 if r.radius is None else r.radius for r in layout])
    probes = about.probes if probes is None else probes
    search = _Search(k, _unit_rows, 8 * max(1, about.dimensions), query_block, vector_block)
    asked = stage(_named(queries, query_key, vector, "q", about.dimensions), "cell-queries")
    q_names = [c for c in asked.columns if c != "v"]

    def look_into(visits: DataFrame, found: DataFrame | None = None) -> DataFrame:
        """The best rows of what was found before and what lies in the cells of the visits."""
        new = search.scan(visits, held.where(F.col("cell").isin(_visited(visits))), by="cell")
        return stage(_rank(new if found is None else found.drop("rank").unionByName(new), k), "cell-found")

    found = look_into(stage(_visits(asked, centers, lambda d, batch: _places(d) < probes), "cell-visits"))
    seen = probes
    while seen < len(centers):
        # Unit vectors: distance^2 = 2 - 2 cos. One unit of the last digit covers the rounding of the score.
        cosine = F.greatest(F.lit(-1.0), F.col("score") - 10.0**-DIGITS)
        kth = found.where(F.col("rank") == k).select(*q_names, F.sqrt(2 - 2 * cosine).alias("reach"))
        same = functools.reduce(Column.__and__, [asked[n].eqNullSafe(kth[n]) for n in q_names])
        waiting = asked.join(kth, same, "left").select(asked["*"], kth["reach"])
        if not exact:
            waiting = waiting.where(F.col("reach").isNull())

        def further(distances: np.ndarray, batch: pa.RecordBatch, seen: int = seen) -> np.ndarray:
            reach = batch.column("reach").to_numpy(zero_copy_only=False).astype(np.float64)
            reach = np.where(np.isnan(reach), np.inf, reach)[:, None]
            places = _places(distances)
            return (places >= seen) & (places < 2 * seen) & (distances - radii[None, :] <= reach + 1e-9)

        more = stage(_visits(waiting, centers, further), "cell-visits")
        if not more.isEmpty():
            found = look_into(more, found)
        seen *= 2
    return _result(found.drop("rank"), k, query_key, about["keys"][0] if len(about["keys"]) == 1 else about["keys"])


def knn_cells(
    queries: DataFrame,
    vectors_: DataFrame,
    k: int = TOP_K,
    cells: int | None = None,
    probes: int | None = None,
    exact: bool = False,
    query_key: Keys = "vec_id",
    vector_key: Keys = "vec_id",
    vector: str = "embedding",
    **blocks: int,
) -> DataFrame:
    """``write_cells`` into a work folder, then ``search_cells``: for vectors that are searched once."""
    path = work_folder(queries.sparkSession, "cells")
    write_cells(vectors_, path, cells, vector_key, vector)
    return search_cells(queries, path, k, probes, exact, query_key, vector, **blocks)
