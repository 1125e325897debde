"""Ranked retrieval that stops early: postings in order of impact, with the highest weight of every block known.

A posting's block is its dimension and its impact band (weights within a constant factor). The directory has one row per
block: its highest weight and its size. Its length follows the number of dimensions and bands, never that of the rows.
A search opens the strongest blocks only, until no row outside them can reach the k-th best score:

* what the unopened blocks of all dimensions could add up to at most bounds every row that was not met;
* a row that was met has its partial sum, and above that only the bounds of the dimensions it was not met in;
* the few rows whose bound reaches the k-th score get their exact score from the vectors stored by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from papertrove.config import TOP_K
from papertrove.functions import vectors
from papertrove.operators.search import DIGITS, open_dimensions, question_entries, stored_keys, weight_of
from papertrove.sources.storage import stage

# Bands per halving of the weight, and the last band, which holds everything smaller.
BANDS_PER_HALF = 8
LAST_BAND = 127
# A dimension's postings, strongest first, are counted in stretches of this many.
BLOCK_ROWS = 64
# The first round opens blocks until the bound of unmet rows has fallen to this share, and looks at so many rows per answer.
FIRST_SHARE = 0.45
FIRST_ROWS = 20
# Scores are compared after rounding, so a bound must miss the k-th score by more than this to rule a row out.
MARGIN = 2 * 10.0**-DIGITS


def impact_band(weight: Column) -> Column:
    """The band of a weight between 0 and 1; lower bands weigh more."""
    band = F.floor(-F.log2(weight) * BANDS_PER_HALF)
    return F.greatest(F.lit(0), F.least(F.lit(LAST_BAND), band)).cast("int")


def write_ranked(
    rows: DataFrame, text: str, keys: Sequence[str], path: str, parts: int = 64, buckets: int = 64,
    dimensions: int = vectors.DIMENSIONS,
) -> None:
    """Store the text vectors of ``rows`` as blocks by impact, their directory, and the vectors themselves by key.

    ``parts`` and ``buckets`` are folders of dimensions and of keys and should grow with the data; adaptive execution
    cuts a folder that holds a dimension most rows have into even files. The vectors are computed once.
    """
    spark = rows.sparkSession
    held = rows.select(*stored_keys(keys), vectors.hash_embed(F.col(text), dimensions).alias("vector"))
    names = [f"key_{i}" for i in range(len(keys))]
    bucket = F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")
    by_key = held.withColumn("bucket", bucket).hint("rebalance", "bucket").sortWithinPartitions("bucket", *names)
    by_key.write.partitionBy("bucket").parquet(f"{path}/vectors")
    stored = spark.read.schema(by_key.schema).parquet(f"{path}/vectors")
    entries = stored.select(*names, F.inline("vector"))
    placed = entries.select(*names, "dim", impact_band(F.col("weight")).alias("band"), "weight", (F.col("dim") % parts).alias("part"))
    ordered = placed.hint("rebalance", "part").sortWithinPartitions("part", "dim", "band", *names)
    ordered.write.partitionBy("part").parquet(f"{path}/blocks")
    directory = spark.read.schema(ordered.schema).parquet(f"{path}/blocks").groupBy("dim", "band")
    directory = directory.agg(F.max("weight").alias("top"), F.count("*").alias("rows"))
    directory.repartitionByRange("dim").sortWithinPartitions("dim", "band").write.parquet(f"{path}/directory")
    about = spark.createDataFrame(
        [(parts, buckets, dimensions, list(keys), *(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) for df in (ordered, by_key)))],
        "parts int, buckets int, dimensions int, keys array<string>, blocks string, vectors string",
    )
    about.write.parquet(f"{path}/about")


@dataclass
class _List:
    """The blocks of one dimension of a question, strongest first, and how many of them are open."""

    dim: int
    asked: float
    blocks: list[tuple[int, float, int]]  # band, highest weight, rows
    opened: int = 0

    def bound(self, opened: int | None = None) -> float:
        """The most that an unopened block adds to a score."""
        at = self.opened if opened is None else opened
        return self.asked * self.blocks[at][1] if at < len(self.blocks) else 0.0

    def size(self, opened: int) -> int:
        """Stretches of ``BLOCK_ROWS`` postings that the strongest blocks lie in."""
        return -(-sum(rows for _, _, rows in self.blocks[:opened]) // BLOCK_ROWS)

    def steepest(self) -> tuple[float, int]:
        """The best fall of the bound per row read, and how many blocks to open for it."""
        best, rows = (-1.0, self.opened), 0
        for at in range(self.opened, len(self.blocks)):
            rows += self.blocks[at][2]
            best = max(best, ((self.bound() - self.bound(at + 1)) / rows, at + 1))
        return best


def open_until(lists: list[_List], bound: float) -> float:
    """Open blocks, those that lower the bound most per row first, until it is below ``bound``; the bound reached."""
    while (left := sum(each.bound() for each in lists)) >= bound:
        unread = [each for each in lists if each.opened < len(each.blocks)]
        if not unread:
            break
        chosen = max(unread, key=lambda each: each.steepest())
        chosen.opened = chosen.steepest()[1]
    return left


def _stored(spark: SparkSession, path: str, name: str, about: Row) -> DataFrame:
    """A stored table by its known schema, since an empty one has no file to tell it."""
    return spark.read.schema(about[name]).parquet(f"{path}/{name}")


def _met(spark: SparkSession, path: str, lists: list[_List], about: Row, names: list[str]) -> DataFrame:
    """Rows of the open blocks: partial sum, and the most that their score can be less the bound of all lists.

    The scan opens the folders of the open dimensions and, by their statistics, the pages of the open bands.
    """
    opened = [each for each in lists if each.opened]
    wanted = {each.dim: (F.col("dim") == each.dim) & (F.col("band") <= each.blocks[each.opened - 1][0]) for each in opened}
    postings = open_dimensions(_stored(spark, path, "blocks", about), wanted, about.parts)
    share = F.col("weight") * weight_of(F.col("dim"), {each.dim: each.asked for each in lists})
    bound = weight_of(F.col("dim"), {each.dim: each.bound() for each in lists})
    return postings.groupBy(*names).agg(F.sum(share).alias("partial"), F.sum(share - bound).alias("above"))


def _scored(spark: SparkSession, path: str, rows: DataFrame, lists: list[_List], about: Row, names: list[str]) -> DataFrame:
    """Exact scores of some rows by their keys; only their buckets are read."""
    wanted = rows.select(*names, F.pmod(F.xxhash64(*names), F.lit(about.buckets)).cast("int").alias("bucket"))
    folders = [r[0] for r in wanted.select("bucket").distinct().collect()]
    stored = _stored(spark, path, "vectors", about).where(F.col("bucket").isin(folders))
    asked = {each.dim: each.asked for each in lists}
    held = stored.join(wanted, ["bucket", *names], "left_semi")
    score = F.aggregate(F.col("vector"), F.lit(0.0), lambda total, e: total + e["weight"] * weight_of(e["dim"], asked))
    return held.select(*names, F.round(score, DIGITS).alias("score"))


def search_ranked(spark: SparkSession, path: str, question: str | DataFrame, k: int = TOP_K) -> DataFrame:
    """``(keys, score, blocks_opened, blocks)`` of the ``k`` best rows that share a token with the question.

    Same rows and scores as ``search_postings``; ``blocks`` counts the stretches of ``BLOCK_ROWS`` postings in the
    question's dimensions, ``blocks_opened`` those that were read. Two rounds: strong blocks give ``k`` good
    rows and with them a score to beat, then blocks are opened until nothing outside them can beat it. A question
    without tokens, or with none that occurs, has no answer.
    """
    about = spark.read.parquet(f"{path}/about").first()
    keys, names = list(about["keys"]), [f"key_{i}" for i in range(len(about["keys"]))]
    entries = dict(question_entries(spark, question, about.dimensions))
    directory = spark.read.parquet(f"{path}/directory").where(F.col("dim").isin(list(entries)))
    blocks: dict[int, list[tuple[int, float, int]]] = {}
    for row in directory.orderBy("dim", "band").collect():
        blocks.setdefault(row["dim"], []).append((row["band"], row["top"], row["rows"]))
    lists = [_List(dim, entries[dim], found) for dim, found in blocks.items()]
    best = 0.0
    if lists:
        open_until(lists, FIRST_SHARE * sum(each.bound() for each in lists))
        strong = _met(spark, path, lists, about, names).orderBy(F.desc("partial"), *names).limit(FIRST_ROWS * k)
        first = _scored(spark, path, stage(strong, "ranked-first"), lists, about, names)
        scores = sorted((r["score"] for r in first.select("score").collect()), reverse=True)
        best = scores[k - 1] if len(scores) >= k else 0.0
    left = open_until(lists, best - MARGIN)
    counts = [F.lit(sum(each.size(n) for each, n in ends)).cast("long") for ends in (
        [(each, each.opened) for each in lists], [(each, len(each.blocks)) for each in lists])]
    if lists:
        met = _met(spark, path, lists, about, names).where(F.col("above") + F.lit(left) >= best - MARGIN)
        found = _scored(spark, path, stage(met.select(*names), "ranked-met"), lists, about, names)
    else:
        found = _stored(spark, path, "vectors", about).select(*names, F.lit(0.0).alias("score")).limit(0)
    named = [F.col(name).alias(key) for name, key in zip(names, keys, strict=True)]
    top = found.orderBy(F.desc("score"), *names).limit(k)
    return top.select(*named, "score", counts[0].alias("blocks_opened"), counts[1].alias("blocks"))
