"""From raw documents to packed training sequences: every stage is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from papertrove.llm import decontaminate, packing, quality_rules, secret_scan, simhash
from papertrove.session import ship_package
from papertrove.sources import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that fail a rule, and documents that the rules reject."""
    return quality_rules.clean_documents(docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near-duplicates."""
    ship_package(spark)
    return simhash.first_of_each(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a benchmark covers at least one word in twenty."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; no document goes."""
    ship_package(spark)
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    ship_package(spark)
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", clean_lines),
    ("near-duplicates", keep_first_copies),
    ("decontamination", remove_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: Tokens, fingerprints and parsed secrets have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
