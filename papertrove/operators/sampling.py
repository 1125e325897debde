"""Samples of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def bounded_sample(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, the same ones each time: those with the smallest hashes of the columns ``by``.

    Rows that are surely not among them are dropped where they lie, by a share that follows from the number of rows, so
    little more than the sample itself is brought together.
    """
    number = df.count()
    chance = F.pmod(F.xxhash64(*by), F.lit(_RANGE))
    if number > rows:
        wanted = rows + 6 * rows**0.5 + 10
        df = df.where(chance <= int(_RANGE * min(1.0, wanted / number)))
    return df.orderBy(chance, *by).limit(rows)
