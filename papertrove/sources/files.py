"""Files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def scan_binary(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """One row per file: path, modificationTime, length, content (and hidden ``_metadata``).

    ``glob`` is applied while listing, before any byte is read. Project ``content`` away as early as possible: the scan
    only opens a file when the column is used.
    """
    return _reader(spark, "binaryFile", glob).load(path)


def scan_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """The bytes of the same files as rows: what lies between two line feeds, in ``value``, whatever it is.

    Unlike ``content`` of ``scan_binary`` a long file comes in splits, named by ``_metadata.file_block_start``.
    """
    return _reader(spark, "text", glob).option("lineSep", "\n").load(path)


def _reader(spark: SparkSession, kind: str, glob: str | None) -> DataFrameReader:
    reader = spark.read.format(kind).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def source_path(col: Column | str) -> Column:
    """Path without its scheme: ``file:///a/b`` and ``https://a/b`` both become ``/a/b``."""
    return F.regexp_replace(col, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def binary_source(files: DataFrame) -> DataFrame:
    """File rows under the names the document and image jobs use."""
    return files.select(
        source_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("modificationTime").alias("source_modification_time"),
        F.col("length").alias("source_length"),
        F.col("content").alias("source_content"),
    )
