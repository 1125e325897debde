"""Registered queries over vectors and top-k search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.functions import text
from papertrove.operators import documents as docs
from papertrove.operators import quantized, ranked, search
from papertrove.operators.tables import change_feed
from papertrove.plans.jobs import chunk_search
from papertrove.plans.oracle_parts import fixed_chunks_sql, vectors_sql
from papertrove.plans.registry import registered
from papertrove.sources.storage import stage, work_folder
from papertrove.sources.tables import load, load_spread
from papertrove.streaming.cells import LiveCells, open_cells
from papertrove.streaming.sync import change_stream

SEARCH_SQL = f"""
WITH chunks AS ({fixed_chunks_sql('documents', 'doc_id')}),
question AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
v AS ({vectors_sql('chunks', 'doc_id, chunk_index', 'chunk')}),
q AS (SELECT dim, weight AS asked FROM ({vectors_sql('(SELECT 0 AS one, text FROM question)', 'one', 'text')})),
hits AS (SELECT doc_id, chunk_index, sum(weight * asked) AS s FROM v JOIN q USING (dim) GROUP BY ALL),
best AS (
  SELECT doc_id, chunk_index, chunk AS content, round(coalesce(s, 0), 6) AS score
  FROM chunks LEFT JOIN hits USING (doc_id, chunk_index)
  ORDER BY score DESC, doc_id, chunk_index LIMIT 5)"""


def _question(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "benchmark").orderBy("item_id").limit(1).select("text")


@registered(f"{SEARCH_SQL} SELECT doc_id, chunk_index, content, score FROM best")
def search_one(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks that best match the first benchmark question."""
    return chunk_search(load_spread(spark, folder, "documents", "doc_id", "text"), _question(spark, folder))


@registered(f"{SEARCH_SQL} SELECT doc_id, chunk_index, score FROM best")
def search_postings(spark: SparkSession, folder: str) -> DataFrame:
    """The answers of ``search_one`` out of vectors stored by dimension."""
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    chunks = docs.explode_chunks(rows, text.chunk_fixed(F.col("text")), name="content").drop("text")
    path, keys = work_folder(spark, "postings"), ["doc_id", "chunk_index"]
    search.write_postings(chunks, "content", keys, path, parts=8)
    return search.search_postings(spark, path, _question(spark, folder))


@registered(f"{SEARCH_SQL} SELECT doc_id, chunk_index, score, true AS under_half FROM best")
def search_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The answers of ``search_one`` out of postings by impact, of which less than half of the blocks are opened."""
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    chunks = docs.explode_chunks(rows, text.chunk_fixed(F.col("text")), name="content").drop("text")
    path = work_folder(spark, "ranked")
    ranked.write_ranked(chunks, "content", ["doc_id", "chunk_index"], path, parts=8, buckets=8)
    found = ranked.search_ranked(spark, path, _question(spark, folder))
    return found.select("doc_id", "chunk_index", "score", (2 * F.col("blocks_opened") < F.col("blocks")).alias("under_half"))


@registered(f"""{SEARCH_SQL}
SELECT content AS field_0, CAST(doc_id AS VARCHAR) AS field_1, CAST(chunk_index AS VARCHAR) AS field_2, score FROM best""")
def search_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same answers as positional rows in a requested column order."""
    columns = ["content", "doc_id", "chunk_index"]
    rows = search.result_rows(chunk_search(load_spread(spark, folder, "documents", "doc_id", "text"), _question(spark, folder)), columns)
    fields = [search.field_at(F.col("row"), i).alias(f"field_{i}") for i in range(len(columns))]
    return rows.select(*fields, "score")


@registered(f"""
SELECT doc_id, dim, round(weight, 6) AS weight FROM ({vectors_sql('documents', 'doc_id', 'text')})""")
def hash_embed(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    entries = search.vector_entries(rows, "text", ["doc_id"])
    return entries.select("doc_id", "dim", F.round("weight", 6).alias("weight"))


@registered(f"""
WITH v AS ({vectors_sql('documents', 'doc_id', 'text')}),
q AS ({vectors_sql('benchmark', 'item_id', 'text')}),
hits AS (
  SELECT item_id, doc_id, round(sum(v.weight * q.weight), 6) AS score FROM q JOIN v USING (dim) GROUP BY ALL)
SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM hits QUALIFY rank <= 5""")
def search_many(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that best match every benchmark question, in one pass over the documents."""
    index = search.embed_text(load_spread(spark, folder, "documents", "doc_id", "text"), "text")
    asked = search.embed_text(load(spark, folder, "benchmark").select("item_id", "text"), "text")
    found = search.search_many(index, asked, question_key="item_id", key="doc_id")
    return found.select(F.col("query_id").alias("item_id"), F.col("neighbor_id").alias("doc_id"), "score", "rank")


KNN_SQL = """
WITH pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
         round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings q, embeddings v)
SELECT query_id, neighbor_id, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS INTEGER) AS rank
FROM pairs QUALIFY rank <= 5"""


@registered(KNN_SQL)
def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    return search.knn_exact(vectors, vectors)


@registered(KNN_SQL)
def knn_blocked(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    return search.knn_blocked(vectors, vectors, query_block=300, vector_block=200)


@registered(KNN_SQL)
def knn_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Search by cells with exact completion: the rows of ``knn_exact``."""
    vectors = load(spark, folder, "embeddings")
    return search.knn_cells(vectors, vectors, exact=True)


@registered()
def knn_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Search by cells alone; approximate, so ``knn_recall`` checks what it finds instead of its rows."""
    vectors = load(spark, folder, "embeddings")
    return search.knn_cells(vectors, vectors)


@registered("""
SELECT count(*) AS n_queries, count(*) * 5 AS n_rows, true AS recall_reached, 0::BIGINT AS better_than_exact FROM embeddings""")
def knn_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate answers beside the exact ones: full lists, recall of at least 0.95, no score above the exact one."""
    vectors = load(spark, folder, "embeddings")
    near = search.knn_cells(vectors, vectors).withColumnRenamed("score", "near_score")
    exact = stage(search.knn_exact(vectors, vectors), "exact-answers")
    both = near.join(exact.select("query_id", "neighbor_id", F.lit(1).alias("hit")), ["query_id", "neighbor_id"], "left")
    by_rank = both.join(exact.select("query_id", "rank", "score"), ["query_id", "rank"])
    return by_rank.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recall_reached"),
        F.coalesce(F.sum((F.col("near_score") > F.col("score")).cast("long")), F.lit(0)).alias("better_than_exact"),
    )


CODE_BYTES = 16


@registered(f"""
SELECT count(*) AS n_queries, count(*) * 5 AS n_rows, true AS recall_reached, 0::BIGINT AS better_than_exact,
       {CODE_BYTES}::BIGINT AS bytes_per_vector FROM embeddings""")
def quantized_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Answers out of codes of 16 bytes a vector beside the exact ones: full lists, recall of at least 0.95."""
    vectors, path = load(spark, folder, "embeddings"), work_folder(spark, "quantised")
    quantized.write_codes(vectors, path, CODE_BYTES)
    near = quantized.knn_quantized(spark, path, vectors, vectors).withColumnRenamed("score", "near_score")
    exact = stage(search.knn_exact(vectors, vectors), "exact-answers")
    both = near.join(exact.select("query_id", "neighbor_id", F.lit(1).alias("hit")), ["query_id", "neighbor_id"], "left")
    by_rank = both.join(exact.select("query_id", "rank", "score"), ["query_id", "rank"])
    size = spark.read.parquet(f"{path}/codes").select(F.max(F.octet_length("code")).cast("long")).scalar()
    return by_rank.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recall_reached"),
        F.coalesce(F.sum((F.col("near_score") > F.col("score")).cast("long")), F.lit(0)).alias("better_than_exact"),
    ).withColumn("bytes_per_vector", size)


# Every fifth vector is spoiled in one of four ways, told apart by its id.
DIRTY_SQL = """
WITH dirty AS (
  SELECT vec_id, CASE vec_id % 20
    WHEN 1 THEN NULL
    WHEN 6 THEN list_concat([NULL], CAST(embedding AS DOUBLE[])[2:])
    WHEN 11 THEN list_concat([CAST('nan' AS DOUBLE)], CAST(embedding AS DOUBLE[])[2:])
    WHEN 16 THEN CAST(embedding AS DOUBLE[])[2:]
    ELSE CAST(embedding AS DOUBLE[]) END AS embedding
  FROM embeddings),
clean AS (SELECT * FROM dirty WHERE vec_id % 5 <> 1)"""


def _dirty(spark: SparkSession, folder: str) -> DataFrame:
    kind, doubles = F.col("vec_id") % 20, F.col("embedding").cast("array<double>")
    rest = F.slice(doubles, 2, F.size(doubles) - 1)
    spoiled = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 6, F.concat(F.array(F.lit(None).cast("double")), rest))
        .when(kind == 11, F.concat(F.array(F.lit(float("nan"))), rest))
        .when(kind == 16, rest)
        .otherwise(doubles)
    )
    return load(spark, folder, "embeddings").select("vec_id", spoiled.alias("embedding"))


@registered(f"""{DIRTY_SQL},
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, round(list_cosine_similarity(q.embedding, v.embedding), 6) AS score
  FROM clean q, clean v)
SELECT query_id, neighbor_id, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS INTEGER) AS rank
FROM pairs QUALIFY rank <= 5""")
def knn_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors that are null, hold nulls or NaN or have another length neither ask nor answer, and harm no other."""
    vectors = _dirty(spark, folder)
    return search.knn_exact(vectors, vectors)


@registered("""
SELECT vec_id, CASE vec_id % 20 WHEN 1 THEN 'no vector' WHEN 6 THEN 'null element' WHEN 11 THEN 'not finite'
  ELSE 'other length' END AS reason
FROM embeddings WHERE vec_id % 5 = 1""")
def knn_lost(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors that ``knn_dirty`` leaves out, with the reason."""
    return search.unsearchable(_dirty(spark, folder), "vec_id", "embedding")


# A table of vectors after a change feed: rows removed, vectors turned round, rows added.
FOLLOWED_SQL = """
WITH live AS (
  SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN list_reverse(CAST(embedding AS DOUBLE[]))
                      ELSE CAST(embedding AS DOUBLE[]) END AS embedding
  FROM embeddings WHERE vec_id % 7 <> 3
  UNION ALL
  SELECT vec_id + 1000000000, [-x for x in CAST(embedding AS DOUBLE[])] FROM embeddings WHERE vec_id % 4 = 1)"""


def _followed(spark: SparkSession, folder: str) -> tuple[LiveCells, DataFrame]:
    """An index that was synced with all vectors and then with a feed of their changes, and the table as it is then."""
    doubles = F.col("embedding").cast("array<double>")
    first = load(spark, folder, "embeddings").select("vec_id", doubles.alias("embedding"))
    turned = F.when(F.col("vec_id") % 5 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    kept = first.where(F.col("vec_id") % 7 != 3).select("vec_id", turned.alias("embedding"))
    added = first.where(F.col("vec_id") % 4 == 1).select(
        (F.col("vec_id") + 1000000000).alias("vec_id"), F.transform("embedding", lambda x: -x).alias("embedding")
    )
    second = kept.unionByName(added)
    feeds, index = work_folder(spark, "cell-feeds"), open_cells(work_folder(spark, "live-cells"), "vec_id", "version")
    old = None
    for version, new in enumerate([first, second], 1):
        change_feed(old, new, "vec_id", version).write.parquet(f"{feeds}/{version}")
        index.sync(change_stream(spark, f"{feeds}/*"), deleted=F.col("removed"))
        old = new
    return index, second


@registered(f"""{FOLLOWED_SQL},
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, round(list_cosine_similarity(q.embedding, v.embedding), 6) + 0.0 AS score
  FROM live q, live v)
SELECT query_id, neighbor_id, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS INTEGER) AS rank
FROM pairs QUALIFY rank <= 5""")
def knn_followed(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of cells that followed a change feed, every cell looked into: those of an exact search."""
    index, vectors = _followed(spark, folder)
    return index.search(spark, vectors, probes=1 << 30)


@registered(f"""{FOLLOWED_SQL}
SELECT count(*) AS n_queries, count(*) * 5 AS n_rows, true AS recall_reached, 0::BIGINT AS better_than_exact FROM live""")
def followed_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The same index asked in as many cells as it has measured to need, beside the exact answers: recall of 0.95."""
    index, vectors = _followed(spark, folder)
    near = index.search(spark, vectors).withColumnRenamed("score", "near_score")
    exact = stage(search.knn_exact(vectors, vectors), "exact-answers")
    both = near.join(exact.select("query_id", "neighbor_id", F.lit(1).alias("hit")), ["query_id", "neighbor_id"], "left")
    return both.join(exact.select("query_id", "rank", "score"), ["query_id", "rank"]).agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recall_reached"),
        F.coalesce(F.sum((F.col("near_score") > F.col("score")).cast("long")), F.lit(0)).alias("better_than_exact"),
    )


@registered(f"""
WITH chunks AS ({fixed_chunks_sql('documents', 'doc_id')}),
v AS ({vectors_sql('chunks', 'doc_id, chunk_index', 'chunk')}),
q AS ({vectors_sql('benchmark', 'item_id', 'text')}),
hits AS (
  SELECT item_id, doc_id, chunk_index, round(sum(v.weight * q.weight), 6) AS score FROM q JOIN v USING (dim) GROUP BY ALL)
SELECT 'item-' || item_id AS item, doc_id, chunk_index, score,
       CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_index) AS INTEGER) AS rank
FROM hits QUALIFY rank <= 5""")
def search_many_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Batch search with text keys of questions and the composite keys of chunks."""
    rows = load(spark, folder, "documents").select("doc_id", "text")
    chunks = docs.explode_chunks(rows, text.chunk_fixed(F.col("text")), name="content").drop("text")
    index = search.embed_text(chunks, "content").drop("content")
    items = load(spark, folder, "benchmark").select(F.concat(F.lit("item-"), "item_id").alias("item"), "text")
    asked = search.embed_text(items, "text")
    found = search.search_many(index, asked, question_key="item", key=["doc_id", "chunk_index"])
    return found.select(F.col("query_id").alias("item"), "neighbor_id.*", "score", "rank")
