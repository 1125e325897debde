"""Files and texts to chunks and pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.functions import media, text
from papertrove.operators.names import private
from papertrove.sources.files import binary_source

Chunker = Callable[[Column], Column]


def explode_chunks(df: DataFrame, chunks: Column, index: str | None = "chunk_index", name: str = "chunks") -> DataFrame:
    """One row per chunk beside the other columns; rows without chunks vanish (see ``lost_rows``)."""
    keep = [F.col(c) for c in df.columns]
    if index is None:
        return df.select(*keep, F.explode(chunks).alias(name))
    return df.select(*keep, F.posexplode(chunks).alias(index, name))


def explode_structs(df: DataFrame, structs: Column, drop: Sequence[str] = ()) -> DataFrame:
    """One row per struct with its fields as columns; ``drop`` names inputs that are not carried along."""
    keep = [F.col(c) for c in df.columns if c not in drop]
    item = private("item")
    return df.select(*keep, F.explode(structs).alias(item)).select("*", f"{item}.*").drop(item)


def lost_rows(inputs: DataFrame, outputs: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inputs that a generator dropped. Only the key of ``outputs`` is read, once per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return inputs.join(outputs.select(*keys).distinct(), keys, "left_anti")


def export_documents(files: DataFrame, format: str = "markdown") -> DataFrame:
    """Binary file rows to ``(source_path, content)``; the bytes go no further than this projection."""
    source = binary_source(files).select("source_path", "source_content")
    return source.select(
        "source_path",
        text.export_document(F.col("source_content"), media.sniff_mime(F.col("source_content")), format).alias("content"),
    )


def process_documents(documents: DataFrame, chunker: Chunker = text.chunk_recursive) -> DataFrame:
    """``(source_path, content)`` to ``(source_path, chunk_index, chunks)``; no shuffle."""
    return explode_chunks(documents, chunker(F.col("content"))).drop("content")


def process_pages(documents: DataFrame, chunker: Chunker = text.chunk_recursive, delimiter: str = "\f") -> DataFrame:
    """``(source_path, content)`` to ``(source_path, page_number, chunk_index, chunks)``.

    Pages are cut first, so that no chunk spans two of them; no shuffle.
    """
    pages = explode_structs(documents, text.split_pages(F.col("content"), delimiter), drop=["content"])
    return chunk_pages(pages, chunker)


def chunk_pages(pages: DataFrame, chunker: Chunker = text.chunk_recursive) -> DataFrame:
    """Rows with a ``page_content`` to one row per chunk of the page."""
    return explode_chunks(pages, chunker(F.col("page_content"))).drop("page_content")


def index_projection(chunks: DataFrame, text_column: str = "chunks", columns: Sequence[str] = ("source_path",)) -> DataFrame:
    """The columns an index table keeps, in order, the text last and named ``content``."""
    return chunks.select(*columns, F.col(text_column).alias("content"))
