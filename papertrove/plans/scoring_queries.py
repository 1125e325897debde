"""Registered queries over model scoring and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.config import CLASS_NAMES
from papertrove.functions.media import data_url, to_base64
from papertrove.operators import score_ledger, scoring
from papertrove.plans.registry import registered
from papertrove.sources.storage import work_folder
from papertrove.sources.tables import load, load_spread
from papertrove.sources.tables import spread_by_weight as spread_heavy

# A class list in which ``user`` appears twice, ``assistant`` has no prompt and ``system`` is missing.
ROLE_PROMPTS = (
    ("default", "Say what it is."),
    ("user", "Quote the question."),
    ("assistant", None),
    ("user", "Never used."),
)
PROMPT_SQL = "CASE role WHEN 'user' THEN 'Quote the question.' ELSE 'Say what it is.' END"


def _text_length(text: str | None) -> int:
    return len(text)


@registered("SELECT doc_id, length(text) AS value, CAST(NULL AS VARCHAR) AS error FROM documents")
def score_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    scored = scoring.score_batches(rows, ["text"], "scored", T.LongType(), lambda: _text_length)
    return scored.select("doc_id", "scored.value", "scored.error")


@registered("SELECT doc_id, length(text) AS value, CAST(NULL AS VARCHAR) AS error, 0::BIGINT AS scored_again FROM documents")
def score_once(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the documents scored, then all: the second job scores the rest, and a third one nothing."""
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    ledger = score_ledger.ScoreLedger(work_folder(spark, "scores"), "length", T.LongType())

    def run(df: DataFrame) -> DataFrame:
        return score_ledger.score_once(df, ["text"], "scored", ledger, lambda: lambda texts: [len(text) for text in texts], 512)

    run(rows.where(F.col("doc_id") % 2 == 0))
    run(rows)
    before = spark.read.option("recursiveFileLookup", "true").parquet(f"{ledger.path}/results").count()
    scored = run(rows)
    after = spark.read.option("recursiveFileLookup", "true").parquet(f"{ledger.path}/results").count()
    return scored.select("doc_id", "scored.value", "scored.error", F.lit(after - before).cast("long").alias("scored_again"))


@registered("""
WITH w AS (
  SELECT page_id, CASE WHEN page_id = (SELECT min(page_id) FROM pages) THEN (SELECT sum(length(html)) FROM pages) ELSE length(html) END::DOUBLE AS w
  FROM pages),
big AS (SELECT page_id, w, w >= (SELECT sum(w) FROM w) / 8 AS heavy FROM w),
told AS (SELECT count(*) FILTER (heavy) AS n, sum(w) FILTER (NOT heavy) AS rest FROM big),
placed AS (
  SELECT w, CASE WHEN heavy THEN row_number() OVER (PARTITION BY heavy ORDER BY page_id) - 1
    ELSE n + least(floor((sum(w) OVER (PARTITION BY heavy ORDER BY page_id) - w / 2) * (8 - n) / rest), 7 - n) END AS part
  FROM big, told)
SELECT CAST(part AS INTEGER) AS part, count(*) AS n_rows, CAST(sum(w) AS BIGINT) AS bytes FROM placed GROUP BY part""")
def spread_by_weight(spark: SparkSession, folder: str) -> DataFrame:
    """Pages, one of them as heavy as all others together, over eight tasks of even weight besides its own."""
    pages = load(spark, folder, "pages").select("page_id", F.length("html").alias("bytes"))
    first, whole = pages.select(F.min("page_id")).scalar(), pages.select(F.sum("bytes")).scalar()
    heavy = pages.withColumn("bytes", F.when(F.col("page_id") == first, whole).otherwise(F.col("bytes")))
    even = spread_heavy(heavy, 8, "bytes", "page_id").withColumn("part", F.spark_partition_id())
    return even.groupBy("part").agg(F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"))


@registered("""
WITH parts AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
centers AS (SELECT label AS class_label, d, avg(x) AS c FROM parts WHERE label <> 0 GROUP BY ALL),
scores AS (
  SELECT vec_id, class_label, round(sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))), 6) AS class_score
  FROM parts JOIN centers USING (d) GROUP BY ALL)
SELECT vec_id, class_label, class_score FROM scores
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY class_score DESC, class_label) = 1""")
def nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector's class out of the closed list: labels stand for class names, and ``default`` is not allowed."""
    rows = load(spark, folder, "embeddings")
    allowed = [label for label, name in enumerate(CLASS_NAMES) if name != "default"]
    centers = scoring.centroids(rows, "label", "embedding")
    found = scoring.nearest_centroid(rows.select("vec_id", "embedding"), "embedding", centers, allowed)
    return found.select("vec_id", "class_label", "class_score")


@registered(f"SELECT conv_id, turn, role, {PROMPT_SQL} AS prompt FROM conversations")
def prompt_fallback(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "conversations").select("conv_id", "turn", "role")
    return scoring.prompt_fallback(rows, "role", ROLE_PROMPTS)


@registered(f"""
SELECT conv_id, turn, 'Summarize this image of a ' || role || ' using the provided tools. Instructions: ' || {PROMPT_SQL}
       AS summary_prompt, 'data:text/plain;base64,' || base64(encode(text)) AS url FROM conversations""")
def build_prompt(spark: SparkSession, folder: str) -> DataFrame:
    """The two message parts of every turn: request text and data URL."""
    rows = load(spark, folder, "conversations")
    asked = scoring.build_prompt(rows, "role", ROLE_PROMPTS)
    url = data_url(F.lit("text/plain"), to_base64(F.encode("text", "utf-8")))
    asked = scoring.with_message(asked, F.col("summary_prompt"), url)
    return asked.select(
        "conv_id", "turn", F.col("message")[0]["text"].alias("summary_prompt"), F.col("message")[1]["url"].alias("url")
    )


@registered("""
SELECT conv_id, n_images, array_to_string(list_transform(range(1, n_images + 1), lambda i: '<|image_' || i || '|>' || chr(10)), '')
       || 'Summarize the deck of slides.' AS deck_prompt
FROM (SELECT conv_id, count(*) AS n_images FROM conversations GROUP BY conv_id)""")
def deck_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.deck_prompt(load(spark, folder, "conversations"), "conv_id")


@registered("""
SELECT doc_id AS name, CAST(greatest(1, coalesce(max(CAST(CAST(turn AS VARCHAR) AS INTEGER)), 1)) AS INTEGER) AS latest_version
FROM documents LEFT JOIN conversations ON doc_id = conv_id GROUP BY doc_id""")
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as version strings of their conversation, asked for every document number."""
    requested = load(spark, folder, "documents").select(F.col("doc_id").alias("name"))
    versions = load(spark, folder, "conversations").select(
        F.col("conv_id").alias("name"), F.col("turn").cast("string").alias("version")
    )
    return scoring.latest_version(requested, versions, "name", "version")
