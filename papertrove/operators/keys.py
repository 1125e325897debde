"""Surrogate keys and key audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from papertrove.sources.storage import stage

# monotonically_increasing_id() keeps the partition in the bits above these and the row's place in these.
ROW_BITS = 33


def generate_key(df: DataFrame, key: str, after: int | None = None) -> DataFrame:
    """A unique, non-null bigint first column with gaps; no shuffle. Values start behind ``after``."""
    start = 0 if after is None else after + 1
    return df.select((F.monotonically_increasing_id() + F.lit(start)).alias(key), "*")


def assign_key(df: DataFrame, key: str, order_by: Sequence[str], start: int = 1, partitions: int | None = None) -> DataFrame:
    """The dense number of each row in the order of its natural key, as first column.

    Same numbers as ``row_number() over (order by ...)`` without moving all rows to one task: rows are range-partitioned
    and sorted, written once with their partition and place, and each partition is shifted by the rows before it. Only
    the row counts of the partitions are summed in one place. ``order_by`` must be unique.
    """
    by_range = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    placed = by_range.sortWithinPartitions(*order_by).withColumn("_place", F.monotonically_increasing_id())
    placed = stage(placed, "assign-key").withColumn("_part", F.shiftright("_place", ROW_BITS))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    in_part = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + in_part + F.lit(start)).cast("long").alias(key), *df.columns
    )


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a null key part, key values used more than once and the rows they hold.

    Counted per key before the shuffle, so a key that holds a large share of the rows costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = df.select(null_key.alias("_null"), *keys).groupBy("_null", *keys).agg(F.count("*").alias("_n"))
    doubled = ~F.col("_null") & (F.col("_n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).alias("n_null_keys"),
        F.count(F.when(doubled, True)).alias("n_repeated_keys"),
        F.coalesce(F.sum(F.when(doubled, F.col("_n"))), F.lit(0)).alias("n_repeated_rows"),
    )


def check_key(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise when the key has nulls or repeats."""
    found = key_violations(df, key).first()
    if found.n_null_keys or found.n_repeated_keys:
        raise ValueError(
            f"key {key} is violated: {found.n_null_keys} rows without a key, {found.n_repeated_keys} repeated keys"
        )
