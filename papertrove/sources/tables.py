"""Tables as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papertrove.sources.storage import stage


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def class_prompts(spark: SparkSession, classes: Iterable[tuple[str, str | None]]) -> DataFrame:
    """The configured class list as ``(class_name, prompt)``; the first entry of a name wins."""
    first: dict[str, str | None] = {}
    for name, prompt in classes:
        first.setdefault(name, prompt)
    return spark.createDataFrame(list(first.items()), "class_name string, prompt string")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Even out rows before costly per-row work over ``partitions``; none leaves them where the scan put them.

    Meant for small inputs in few files. A large scan is split by ``spark.sql.files.maxPartitionBytes`` and needs none.
    """
    return df if partitions is None else df.repartition(partitions)


def spread_by_weight(df: DataFrame, partitions: int, weight: str, key: str | Sequence[str]) -> DataFrame:
    """``df`` over ``partitions`` that carry even shares of ``weight`` (bytes of a file, say) instead of even counts.

    Rows that weigh a whole partition's share or more, of which there are fewer than ``partitions``, get one each. The
    others are laid end to end in the order of their unique ``key``; their place among all weights, by prefix sums over
    the totals of a range partition's tasks, says where they go. Only keys and weights are sorted, and every row is moved
    once. Null and negative weights count as nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = {k: f"key_{i}" for i, k in enumerate(keys)}
    heavy = F.greatest(F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("w")
    light = df.select(*[F.col(f"`{k}`").alias(n) for k, n in named.items()], heavy)
    order = list(named.values())
    placed = light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = stage(placed, "spread-weights").withColumn("part", F.shiftright("place", 33))
    total = placed.agg(F.sum("w")).first()[0] or 0.0
    share = total / partitions
    big = placed.where((F.col("w") >= share) & (F.col("w") > 0))
    whole = big.agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("w")).first()
    left, room = total - whole["w"], partitions - whole["n"]
    is_big = (F.col("w") >= share) & (F.col("w") > 0)
    small = F.when(is_big, 0.0).otherwise(F.col("w"))
    sums = placed.groupBy("part").agg(F.sum(small).alias("s"), F.count(F.when(is_big, 1)).alias("b"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in ("s", "b")])
    inside = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    here = placed.join(sums, "part").select(
        *order, "w",
        (F.col("before_s") + F.coalesce(F.sum(small).over(inside), F.lit(0.0))).alias("s"),
        (F.col("before_b") + F.coalesce(F.count(F.when(is_big, 1)).over(inside), F.lit(0))).alias("b"),
    )
    middle = F.floor((F.col("s") + F.col("w") / 2) * room / (left or 1.0))
    # Weightless rows may all lie at one place; they are dealt out by their key.
    rest = F.lit(whole["n"]) + F.when(F.lit(left <= 0), F.pmod(F.xxhash64(*order), F.lit(max(1, room)))).otherwise(F.least(middle, F.lit(room - 1)))
    target = F.when(is_big, F.col("b")).otherwise(rest).cast("int").alias("target")
    where, own = "_spread_target", "_spread_key"
    goals = here.select(F.struct(*order).alias(own), target.alias(where))
    marked = df.withColumn(own, F.struct(*[F.col(f"`{k}`").alias(n) for k, n in named.items()]))
    return marked.join(goals, own).repartitionById(partitions, F.col(where)).select(*[F.col(f"`{c}`") for c in df.columns])


def load_spread(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table, or some of its columns, over as many partitions as the session gives a shuffle."""
    rows = load(spark, folder, name)
    return spread(rows.select(*columns) if columns else rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
