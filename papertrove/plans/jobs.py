"""The jobs a user runs: build an index table from files, sync it, ask it."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.config import DOCUMENT_BATCH_ROWS, IMAGE_BATCH_ROWS, TOP_K, Settings
from papertrove.functions import text
from papertrove.operators import assets, documents, scoring, search, tables
from papertrove.session import arrow_batch
from papertrove.sources.files import scan_binary
from papertrove.sources.ledger import CHANGED, NEW, REMOVED, SAME, FileLedger
from papertrove.sources.storage import stage
from papertrove.sources.tables import spread
from papertrove.streaming.buckets import BucketedIndex
from papertrove.streaming.sync import SyncedIndex, change_stream


def build_document_index(
    spark: SparkSession, path: str, table: str, root: str, key: str = "id", glob: str | None = None
) -> DataFrame:
    """Files under ``path`` to a keyed table ``(key, source_path, content)`` of chunks."""
    with arrow_batch(spark, DOCUMENT_BATCH_ROWS):
        chunks = documents.process_documents(documents.export_documents(scan_binary(spark, path, glob)))
        rows = stage(chunks, "document-chunks")
        keyed = documents.index_projection(rows, columns=["source_path", "chunk_index"])
        return tables.create_or_replace(keyed, table, key, root, order_by=["source_path", "chunk_index"])


def document_chunks(files: DataFrame) -> DataFrame:
    """``(source_path, chunk_index, content)`` of file rows, exported and cut recursively."""
    return documents.index_projection(documents.process_documents(documents.export_documents(files)), columns=["source_path", "chunk_index"])


def follow_files(
    spark: SparkSession,
    folder: str,
    ledger: FileLedger,
    index: SyncedIndex | BucketedIndex,
    feed: str,
    glob: str | None = None,
    make_chunks: Callable[[DataFrame], DataFrame] = document_chunks,
) -> DataFrame:
    """Bring an index of chunks (key ``source_path, chunk_index``, version ``version``) up to date with a folder.

    Only new and changed files are opened. Chunks that a changed file has no more, and all of a removed one, are removed
    from the index; how many there were is in the ledger. Returns one row: files ``new, changed, removed, same, opened``.
    """
    found = stage(ledger.compare(spark, folder, glob), "file-changes")
    counts = {row["change"]: row["n"] for row in found.groupBy("change").agg(F.count("*").alias("n")).collect()}
    # Spark's driver holds the paths it scans anyway, and a folder of new files is given as such.
    fresh = found.where(F.col("change").isin(NEW, CHANGED))
    opened = counts.get(NEW, 0) + counts.get(CHANGED, 0)
    if opened or counts.get(REMOVED):
        version = ledger.begin(spark)
        chunks = None
        if opened:
            whole = opened == sum(counts.values())
            paths = folder if whole else [row["path"] for row in fresh.select("path").collect()]
            with arrow_batch(spark, DOCUMENT_BATCH_ROWS):
                chunks = stage(make_chunks(scan_binary(spark, paths, glob if whole else None)), "file-chunks")
        empty = spark.createDataFrame([], "source_path string, chunk_index int, content string")
        chunks = empty if chunks is None else chunks
        made = chunks.groupBy("source_path").agg(F.count("*").alias("chunks"))
        now = found.join(made, "source_path", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
        now = stage(now.withColumn("chunks", F.when(F.col("change") == SAME, F.col("old_chunks")).otherwise(F.col("chunks"))), "file-counts")
        gone = now.where(F.col("old_chunks") > F.col("chunks")).select(
            "source_path", F.explode(F.sequence(F.col("chunks").cast("int"), F.col("old_chunks").cast("int") - 1)).alias("chunk_index"),
            F.lit(None).cast("string").alias("content"), F.lit(True).alias("removed"),
        )
        rows = chunks.select("source_path", "chunk_index", "content", F.lit(False).alias("removed")).unionByName(gone)
        rows.withColumn("version", F.lit(version).cast("long")).write.mode("append").parquet(feed)
        index.sync(change_stream(spark, feed), "content", deleted=F.col("removed"))
        ledger.commit(now.where(F.col("change") != REMOVED).select("path", "source_path", "length", "modified", "chunks"))
    names = [F.lit(counts.get(kind, 0)).cast("long").alias(kind) for kind in (NEW, CHANGED, REMOVED, SAME)]
    return spark.range(1).select(*names, F.lit(opened).cast("long").alias("opened"))


def page_chunks(spark: SparkSession, path: str, glob: str | None = None, delimiter: str = "\f") -> DataFrame:
    """Files under ``path`` to ``(source_path, page_number, chunk_index, chunks)``."""
    return documents.process_pages(documents.export_documents(scan_binary(spark, path, glob)), delimiter=delimiter)


def data_url(content: bytes | None, mime_type: str | None) -> str | None:
    """What a model that takes an address gets instead of bytes."""
    if content is None or mime_type is None:
        return None
    return f"data:{mime_type};base64,{base64.b64encode(content).decode()}"


def score_images(
    images: DataFrame,
    classes: Sequence[tuple[str, str | None]],
    make_captioner: Callable[[], Callable],
    make_classifier: Callable[[], Callable],
    make_summarizer: Callable[[], Callable],
    partitions: int | None = None,
) -> DataFrame:
    """Add ``image_caption``, ``image_classification`` and ``image_summary`` to rows with ``extracted_image``.

    Captioner ``(bytes)``, classifier ``(data url, class names)`` and summarizer ``(prompt, data url)`` are loaded once
    per task; ``prompts.CLASSIFY_REQUEST`` is the text to classify with. Rows are spread before the models and written
    once the classes are known, so that no model call is repeated by what looks at them. Data URLs are made where a model
    takes them and never written. A class outside the closed list becomes null.
    """
    names = [name for name, _ in classes]
    rows = spread(images, partitions)
    rows = scoring.score_batches(rows, ["extracted_image"], "_caption", T.StringType(), make_captioner)

    def bounded() -> Callable:
        classify = make_classifier()
        return lambda content, mime_type: classify(data_url(content, mime_type), names)

    def summarizer() -> Callable:
        summarize = make_summarizer()
        return lambda prompt, content, mime_type: summarize(prompt, data_url(content, mime_type))

    image = ["extracted_image", "image_mime_type"]
    rows = scoring.score_batches(rows, image, "_class", T.StringType(), bounded)
    rows = stage(rows, "classified-images").withColumns(
        {
            "image_caption": F.col("_caption.value"),
            "image_classification": F.when(F.col("_class.value").isin(names), F.col("_class.value")),
        }
    )
    rows = scoring.build_prompt(rows, "image_classification", classes)
    rows = scoring.score_batches(rows, ["summary_prompt", *image], "_summary", T.StringType(), summarizer)
    return rows.withColumns(
        {
            "image_summary": F.col("_summary.value"),
            "scoring_error": F.coalesce("_caption.error", "_class.error", "_summary.error"),
        }
    ).drop("_caption", "_class", "_summary", "prompt")


def build_image_index(
    spark: SparkSession,
    path: str,
    image_folder: str,
    table: str,
    root: str,
    classes: Iterable[tuple[str, str | None]],
    make_captioner: Callable[[], Callable],
    make_classifier: Callable[[], Callable],
    make_summarizer: Callable[[], Callable],
    key: str = "id",
    glob: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Files to saved images and a keyed image table; returns the table and the save report."""
    with arrow_batch(spark, IMAGE_BATCH_ROWS):
        images = assets.describe_images(assets.image_files(scan_binary(spark, path, glob)), image_folder)
        scored = score_images(images, list(classes), make_captioner, make_classifier, make_summarizer)
        scored = stage(scored, "scored-images")
        report = assets.save_assets(scored, "image_path", "extracted_image")
        index = assets.image_index_projection(scored)
        order = ["source_path", "page_number", "ordinal"]
        return tables.create_or_replace(index, table, key, root, order_by=order), report


def follow_table(
    old: DataFrame | None,
    new: DataFrame,
    index: SyncedIndex | BucketedIndex,
    feed: str,
    version: int,
    text_column: str = "content",
    full_refresh: bool = False,
) -> None:
    """Write what changed between two states of a table to the feed folder and sync the index from it."""
    tables.change_feed(old, new, index.key, version).write.mode("append").parquet(feed)
    source = change_stream(new.sparkSession, feed)
    options = {"full_refresh": True} if full_refresh else {}
    index.sync(source, text_column, deleted=F.col("removed"), **options)


def ask(index: DataFrame, question: str | DataFrame, settings: Settings) -> DataFrame:
    """The configured number of rows of an index that best match a question, with the configured columns."""
    columns = settings.result_columns or (settings.primary_key, settings.text_column)
    return search.similarity_search(index, question, columns, settings.top_k, key=settings.primary_key)


def chunk_search(
    documents_: DataFrame,
    question: str | DataFrame,
    k: int = TOP_K,
    key: str = "doc_id",
    text_column: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Which chunks of the documents best match a question: chunk, embed, score and keep the best."""
    texts = spread(documents_.select(key, text_column), partitions)
    chunks = documents.explode_chunks(texts, text.chunk_fixed(F.col(text_column)), name="content").drop(text_column)
    index = search.embed_text(chunks, "content")
    return search.similarity_search(index, question, [key, "chunk_index", "content"], k, key=[key, "chunk_index"])
