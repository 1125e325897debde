"""Keys that stay: a registry from natural keys to ids, which numbers only what it has not seen.

Layout::

    keys/commit=3/bucket=17/...   natural keys that commit 3 numbered, in hash buckets of the natural key
    commits/commit=3/             the highest id after commit 3; a commit counts once this is written

Rows of a table meet the buckets of their own keys and no others. A commit that failed half-way is not seen and is
written over by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.operators.keys import assign_key
from papertrove.sources.storage import newest_commit, stage

_KEY, _BUCKET = "_natural", "_bucket"


@dataclass(frozen=True)
class KeyRegistry:
    """Where the registry lives, the columns of the natural key, and the name of the id; one writer at a time."""

    path: str
    natural: tuple[str, ...]
    key: str = "id"
    buckets: int = 64

    def _last(self) -> int | None:
        return newest_commit(f"{self.path}/commits")

    def _natural(self) -> Column:
        """The natural key as one value, which equals itself even where a part of it is null."""
        return F.struct(*self.natural)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.natural), F.lit(self.buckets)).cast("int")

    def known(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """``(natural key, id)`` of all keys, or of those in some buckets; none before the first commit."""
        last = self._last()
        if last is None:
            return None
        rows = spark.read.option("basePath", f"{self.path}/keys").parquet(f"{self.path}/keys")
        rows = rows.where(F.col("commit") <= last)
        if buckets is not None:
            rows = rows.where(F.col(_BUCKET).isin(list(buckets)))
        return rows.select(*self.natural, self.key)

    def register(self, df: DataFrame) -> DataFrame:
        """``(natural key, id)`` of the rows of ``df``; keys not seen before are numbered behind all others, in their order.

        Ids given once never change and are never given again, whatever is inserted, left out or brought back.
        """
        spark, last = df.sparkSession, self._last()
        asked = stage(df.select(*self.natural).distinct().withColumn(_BUCKET, self._bucket()), "registry-asked")
        if last is None:
            fresh, highest = asked.select(*self.natural), 0
        else:
            touched = [r[0] for r in asked.select(_BUCKET).distinct().collect()]
            held = self.known(spark, touched).select(self._natural().alias(_KEY))
            fresh = asked.withColumn(_KEY, self._natural()).join(held, _KEY, "left_anti").select(*self.natural)
            highest = spark.read.parquet(f"{self.path}/commits/commit={last}").first()["highest"]
        commit = 0 if last is None else last + 1
        numbered = assign_key(fresh, self.key, list(self.natural), start=highest + 1)
        numbered = stage(numbered.select(*self.natural, self.key), "registry-new")
        top = numbered.agg(F.max(self.key)).first()[0]
        if top is not None:
            cut = numbered.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
            cut.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/keys/commit={commit}")
            told = spark.createDataFrame([(top,)], "highest long")
            told.write.mode("overwrite").parquet(f"{self.path}/commits/commit={commit}")
        if last is None or not touched:
            return numbered
        return self._of(self.known(spark, touched), asked)

    def _of(self, known: DataFrame, asked: DataFrame) -> DataFrame:
        wanted = asked.select(self._natural().alias(_KEY))
        return known.withColumn(_KEY, self._natural()).join(wanted, _KEY, "left_semi").drop(_KEY)

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the registered id of its natural key in front; a natural key that repeats is an error."""
        if self.key in df.columns:
            raise ValueError(f"the rows have a column {self.key} already")
        counts = df.groupBy(*self.natural).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
        if not counts.isEmpty():
            raise ValueError(f"natural key {list(self.natural)} repeats")
        ids = self.register(df).select(self._natural().alias(_KEY), self.key)
        return df.withColumn(_KEY, self._natural()).join(ids, _KEY).select(self.key, *df.columns)


def open_registry(path: str, natural: str | Sequence[str], **options) -> KeyRegistry:
    names = (natural,) if isinstance(natural, str) else tuple(natural)
    return KeyRegistry(path.rstrip("/"), names, **options)
