"""Differences of snapshots by a tree of digests: only buckets whose digests differ are read.

A snapshot is written in hash buckets of its key. A bucket's digest covers its rows in any order (SHA-256 of every row,
joined by exclusive or, and their number); ``FAN`` neighbouring nodes make a node of the level above, up to one root. Two
snapshots are compared from their roots downwards, and below equal nodes nothing is looked at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from papertrove.operators.tables import table_changes

FAN = 16
LEVELS = 2
_BUCKET = "_bucket"
_TREE = "level int, node long, digest string, rows long"


def row_words(columns: Sequence[str]) -> list[Column]:
    """SHA-256 of a row as eight numbers of 32 bits; names of the columns count, their order does not."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(8)]


def write_digested(df: DataFrame, key: str | Sequence[str], path: str, levels: int = LEVELS) -> None:
    """Write a snapshot in ``FAN ** levels`` buckets of its key, and the tree of their digests."""
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(FAN**levels)).cast("int")
    cut = df.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET)
    cut.write.partitionBy(_BUCKET).parquet(f"{path}/rows")
    about = spark.createDataFrame([(keys, levels, df.schema.json())], "key array<string>, levels int, schema string")
    about.write.parquet(f"{path}/about")
    stored = spark.read.schema(cut.schema).parquet(f"{path}/rows")
    words = row_words(df.columns)
    named = stored.select(F.col(_BUCKET).cast("long").alias("node"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
    joined = named.groupBy("node").agg(*[F.bit_xor(f"w{i}").alias(f"w{i}") for i in range(8)], F.count("*").alias("rows"))
    digest = F.sha2(F.concat_ws(":", F.lit(repr(sorted(df.dtypes))), *[f"w{i}" for i in range(8)], "rows"), 256)
    tree = level = joined.select(F.lit(levels).alias("level"), "node", digest.alias("digest"), "rows")
    for number in range(levels - 1, -1, -1):
        parts = F.array_sort(F.collect_list(F.struct("node", "digest")))
        level = level.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(
            F.sha2(parts.cast("string"), 256).alias("digest"), F.sum("rows").alias("rows")
        )
        level = level.select(F.lit(number).alias("level"), "node", "digest", "rows")
        tree = tree.unionByName(level)
    tree.coalesce(1).write.parquet(f"{path}/tree")


def unequal_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ, found level by level below unequal nodes."""
    levels = {spark.read.parquet(f"{path}/about").first()["levels"] for path in (old, new)}
    if len(levels) > 1:
        raise ValueError("the snapshots have trees of different heights")
    a, b = (spark.read.schema(_TREE).parquet(f"{path}/tree") for path in (old, new))
    nodes = [0]
    for level in range(levels.pop() + 1):
        # At most FAN children of every unequal node.
        wanted = (F.col("level") == level) & F.col("node").isin(nodes)
        both = a.where(wanted).select("node", F.col("digest").alias("was"))
        both = both.join(b.where(wanted).select("node", F.col("digest").alias("now")), "node", "full_outer")
        unequal = [r["node"] for r in both.where(~F.col("was").eqNullSafe(F.col("now"))).select("node").collect()]
        nodes = [n * FAN + i for n in unequal for i in range(FAN)]
    return sorted(unequal)


def digested_rows(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a snapshot, or of some of its buckets alone."""
    schema = StructType.fromJson(json.loads(spark.read.parquet(f"{path}/about").first()["schema"]))
    rows = spark.read.schema(schema.add(_BUCKET, IntegerType())).parquet(f"{path}/rows")
    return (rows if buckets is None else rows.where(F.col(_BUCKET).isin(list(buckets)))).drop(_BUCKET)


def digest_changes(spark: SparkSession, old: str, new: str) -> DataFrame:
    """The rows of ``table_changes`` between two written snapshots; only their unequal buckets are read."""
    keys = {tuple(spark.read.parquet(f"{path}/about").first()["key"]) for path in (old, new)}
    if len(keys) > 1:
        raise ValueError("the snapshots have different keys")
    buckets = unequal_buckets(spark, old, new)
    return table_changes(digested_rows(spark, old, buckets), digested_rows(spark, new, buckets), list(keys.pop()))
