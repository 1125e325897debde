"""Words of many texts at once: positions and 64-bit codes as numpy arrays, and slices of bounded size.

Everything here runs inside tasks, on the Arrow batches that Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for a null id inside packed arrays; it comes before every other id and is null again in results.
NO_ID = -(2**63)
SLICE_BYTES = 4 << 20
HASH_BYTES = 1 << 20
ASCII_SPACE = b"\x20\t\n\x0b\x0c\r"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BYTE_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def id_or_none(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias(column)


def id_back(column: str = "doc_id") -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.Table]:
    """Tables of about ``size`` bytes of text, in the order of the rows; a longer text comes alone."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = weight + np.cumsum(lengths + 16)
        start = 0
        for stop in np.flatnonzero(np.diff(ends // size, prepend=weight // size)) + 1:
            held.append(batch.slice(start, stop - start))
            yield pa.Table.from_batches(held).combine_chunks()
            held, start = [], int(stop)
        if start < batch.num_rows:
            held.append(batch.slice(start))
        weight = int(ends[-1]) % size
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def buffers(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and the ``len + 1`` offsets into them."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    marks = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[marks[0] : marks[-1]], marks - marks[0]


class Words:
    """The words of some texts: runs of bytes other than separators, by default ASCII white space.

    ``starts`` and ``ends`` are byte positions in ``data``; document ``i`` has the words ``bounds[i]:bounds[i + 1]``.
    """

    def __init__(self, texts: pa.ChunkedArray | pa.Array, separators: bytes = ASCII_SPACE):
        self.data, self.offsets = buffers(texts)
        is_word = np.ones(256, bool)
        is_word[np.frombuffer(separators, np.uint8)] = False
        inside = is_word[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def documents(self) -> np.ndarray:
        """The document of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.bounds))

    def codes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit code of every word: a polynomial over its bytes, mixed. Equal words have equal codes everywhere."""
        data = self.data if data is None else data
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            stop = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + HASH_BYTES)))
            low, high = self.starts[at], self.ends[stop - 1]
            powers = np.full(high - low, _MULTIPLIER)
            powers[0] = 1
            np.cumprod(powers, out=powers)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE_CODES[data[low:high]] * powers, out=sums[1:])
            begin = self.starts[at:stop] - low
            back = np.full(high - low, _INVERSE)
            back[0] = 1
            np.cumprod(back, out=back)
            out[at:stop] = (sums[self.ends[at:stop] - low] - sums[begin]) * back[begin]
            at = stop
        return mixed(out ^ (self.ends - self.starts).astype(np.uint64))


def mixed(codes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit codes that spreads every bit."""
    codes = codes ^ (codes >> np.uint64(33))
    codes = codes * np.uint64(0xFF51AFD7ED558CCD)
    codes ^= codes >> np.uint64(33)
    codes *= np.uint64(0xC4CEB9FE1A85EC53)
    codes ^= codes >> np.uint64(33)
    return codes


def run_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """A code of every run of ``length`` consecutive codes, by its first element; ``len(codes) - length + 1`` of them."""
    count = len(codes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(length):
        out *= _MULTIPLIER
        out += codes[i : i + count]
    return mixed(out)


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
