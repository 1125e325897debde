"""Hashed text vectors and products with them."""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DIMENSIONS = 4096
# Tokens whose dimensions a worker keeps.
KNOWN_TOKENS = 1 << 18


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


class _TokenDimensions(dict):
    """Dimension by token, made once per token; forgotten when there are too many to keep."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def __missing__(self, token: str) -> int:
        if len(self) >= KNOWN_TOKENS:
            self.clear()
        self[token] = found = int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % self.dimensions
        return found


@functools.cache
def _embedder(dimensions: int):
    known, split = _TokenDimensions(dimensions), re.compile("[a-z]+").findall
    entry = pa.struct([("dim", pa.int32()), ("weight", pa.float64())])

    def embed(texts: pa.Array) -> pa.Array:
        """Vectors of lower-case texts: the dimensions of all tokens are sorted and counted together."""
        sizes, dims = [], []
        for text in texts.to_pylist():
            found = split(text or "")
            sizes.append(len(found))
            dims += [known[token] for token in found]
        rows = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        places, counts = np.unique(rows * dimensions + np.array(dims, np.int64), return_counts=True)
        rows, weights = places // dimensions, counts.astype(np.float64)
        norms = np.sqrt(np.bincount(rows, weights=weights * weights, minlength=len(sizes)))
        entries = pa.StructArray.from_arrays(
            [pa.array((places % dimensions).astype(np.int32)), pa.array(weights / norms[rows])], fields=list(entry)
        )
        ends = np.searchsorted(rows, np.arange(len(sizes) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), entries)

    return embed


def hash_embed(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Unit-length bag-of-words vector as ``array<struct<dim int, weight double>>``, dims ascending.

    A batch of rows at a time with no shuffle. A null text has a vector without entries.
    """

    def embed(texts: pa.Array) -> pa.Array:
        return _embedder(dimensions)(texts)

    # Arrow finds the types of the function by its annotations, which are text here.
    embed.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(embed, "array<struct<dim:int,weight:double>>")(F.lower(text))


def dense(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """A sparse vector as an array with one place per dimension."""
    places = F.sequence(F.lit(0), F.lit(dimensions - 1))
    return let(
        F.map_from_entries(vector),
        lambda lookup: F.transform(places, lambda d: F.coalesce(F.try_element_at(lookup, d), F.lit(0.0))),
    )


def sparse_dot(vector: Column, dense_side: Column) -> Column:
    """Product of a sparse vector with a dense array."""
    return F.aggregate(
        vector, F.lit(0.0), lambda total, e: total + e["weight"] * F.get(dense_side, e["dim"])
    )


def dot(left: Column, right: Column) -> Column:
    parts = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)


def unit(vector: Column) -> Column:
    """The vector with length 1, as doubles; a zero vector stays zero."""
    return let(
        F.sqrt(dot(vector, vector)),
        lambda norm: F.transform(vector, lambda x: x.cast("double") / F.when(norm == 0, 1.0).otherwise(norm)),
    )
