"""Near-duplicates by SimHash fingerprints, found with tables of distances to reference fingerprints (pivots).

Every fingerprint has a row of Hamming distances to many pivots. Two fingerprints at distance ``d`` differ by at most
``d`` in every coordinate of their rows, so a pair with a larger difference anywhere is discarded without comparing it,
and the survivors are verified bit by bit.

So that no row has to meet every other, pivots come in pairs that differ in one block of bits: the difference of a pair's
two coordinates is the distance within that block alone. With ``BLOCKS`` blocks, two fingerprints within ``MAX_BITS``
bits agree on all of at least ``BLOCKS - MAX_BITS`` blocks, hence on all those blocks' coordinates. Rows are dealt out by
the coordinates of every choice of that many blocks; linked fingerprints meet in at least one of these cells.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.llm.words import id_back, id_or_none, slices, table
from papertrove.operators.names import private
from papertrove.sources import stage

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BLOCKS = 5
PIVOT_PAIRS = 4
#: Rows of a cell that are compared with all others of it; larger cells are searched by changing bits.
COMPARED_ROWS = 1024
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if it is set in over half of the XXH64 hashes of the text's word shingles, repeats included.

    A-Z count as lower case. Fewer words than a shingle are one shingle; no words (null, empty) give zero.
    """
    found = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(word) + 1 for word in found]) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = max(1, len(found) - shingle + 1)
    begins, stops = starts[:last].tolist(), ends[len(found) - last :].tolist()
    digest = xxhash.xxh64_intdigest
    codes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)], ">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(codes), 1 << 16):
        counts += np.unpackbits(codes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(codes)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, code`` of every row: the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            codes = np.array([fingerprint(text, shingle) for text in part.column("text").to_pylist()], np.uint64)
            yield table(schema, doc_id=part.column("doc_id").combine_chunks(), code=codes.view(np.int64))

    kept = documents.select(id_or_none(), F.col("text").cast("string"))
    return kept.mapInArrow(run, "doc_id long, code long")


class PivotTable:
    """Pivots in pairs per block of bits, and the distances of fingerprints to them."""

    def __init__(self, blocks: int = BLOCKS, pairs: int = PIVOT_PAIRS, max_bits: int = MAX_BITS):
        self.blocks, self.pairs, self.max_bits = blocks, pairs, max_bits
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        self.masks = np.array([((1 << int(b)) - (1 << int(a))) for a, b in zip(edges[:-1], edges[1:])], np.uint64)
        first = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, (blocks, pairs), dtype=np.uint64)
        #: ``pivots[b, p, 0]`` and ``pivots[b, p, 1]`` differ in all bits of block ``b`` and nowhere else.
        self.pivots = np.stack([first, first ^ self.masks[:, None]], axis=2)
        self.choices = list(itertools.combinations(range(blocks), blocks - max_bits))

    def distances(self, codes: np.ndarray) -> np.ndarray:
        """Hamming distance of every code to every pivot, ``(codes, blocks, pairs, 2)``."""
        return np.bitwise_count(codes[:, None, None, None] ^ self.pivots[None]).astype(np.int16)

    def cells(self, codes: np.ndarray) -> np.ndarray:
        """A number for every code and choice of blocks, made of the blocks' coordinates; ``(codes, choices)``."""
        rows = self.distances(codes)
        within = (rows[..., 0] - rows[..., 1]).astype(np.int64)
        out = np.empty((len(codes), len(self.choices)), np.int64)
        for i, choice in enumerate(self.choices):
            number = np.full(len(codes), i, np.int64)
            for value in within[:, choice].reshape(len(codes), -1).T:
                number = number * 33 + value + 64
                number ^= number >> 29
            out[:, i] = number
        return out

    def links(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of linked codes of one cell: enough pairs to join all that are linked, directly or through others."""
        if len(codes) <= COMPARED_ROWS:
            return self._compared(codes)
        return self._by_changing_bits(codes)

    def _compared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.distances(codes).reshape(len(codes), -1)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(len(codes) - 1):
            apart = np.abs(rows[i + 1 :] - rows[i]).max(axis=1)
            near = i + 1 + np.flatnonzero(apart <= self.max_bits)
            near = near[np.bitwise_count(codes[near] ^ codes[i]) <= self.max_bits]
            left.append(np.full(len(near), i))
            right.append(near)
        return np.concatenate(left), np.concatenate(right)

    def _by_changing_bits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes)
        ordered = codes[order]
        left, right = [], []
        for size in range(1, self.max_bits + 1):
            for bits in itertools.combinations(range(64), size):
                other = codes ^ np.uint64(sum(1 << bit for bit in bits))
                at = np.minimum(np.searchsorted(ordered, other), len(codes) - 1)
                hit = np.flatnonzero((ordered[at] == other) & (other > codes))
                left.append(hit)
                right.append(order[at[hit]])
        return np.concatenate(left), np.concatenate(right)


def _forest(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For every position the smallest one that it is joined to."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        joined = root.copy()
        np.minimum.at(joined, root[left], low)
        np.minimum.at(joined, root[right], low)
        joined = joined[joined]
        if np.array_equal(joined, root):
            return root
        root = joined


def linked_codes(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between different codes of ``codes`` (``code``, distinct), at most one per code and cell.

    Codes within ``max_bits`` bits are joined by these links, directly or through other codes that are linked as well.
    A cell holds different codes that agree in three of five blocks, so copies never crowd it. Cells are dealt out by
    number; a cell's links are those of a spanning forest, not all its pairs.
    """
    pivots = PivotTable(max_bits=max_bits)
    dealt = pa.schema([("cell", pa.int64()), ("code", pa.int64())])
    found = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("code").to_numpy().view(np.uint64)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                cells = pivots.cells(part)
                yield table(dealt, cell=cells.ravel(), code=np.repeat(part, cells.shape[1]).view(np.int64))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, values in _groups(batches):
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            edges = np.append(np.flatnonzero(np.diff(cells, prepend=cells[0] - 1)), len(cells))
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if end - start > 1:
                    group = values[start:end]
                    root = _forest(len(group), *pivots.links(group))
                    joined = np.flatnonzero(root != np.arange(len(group)))
                    a.append(group[root[joined]])
                    b.append(group[joined])
            yield table(found, a=np.concatenate(a).view(np.int64), b=np.concatenate(b).view(np.int64))

    cells = codes.mapInArrow(deal, "cell long, code long")
    ordered = cells.repartition("cell").sortWithinPartitions("cell")
    return ordered.mapInArrow(link, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and codes of sorted batches, cut only between cells."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        codes = batch.column("code").to_numpy().view(np.uint64)
        if not len(cells):
            continue
        last = np.searchsorted(cells, cells[-1])
        if last:
            held.append((cells[:last], codes[:last]))
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held = []
        held.append((cells[last:], codes[last:]))
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def components(links: DataFrame) -> DataFrame:
    """``code, root`` for every code in ``links`` (``a, b``): all codes that are joined have the same root.

    Links are rewritten in rounds (every neighbour of a code, then the code itself, is linked to the smallest of them)
    until nothing changes; each round is written to the shared folder. The number of rounds grows with the logarithm of
    the longest chain, and a round never holds more links than the one before it.
    """
    current = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = current.union(current.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # A code that is the smallest of its neighbours keeps its links; the others hand theirs to the smallest.
        large = stage(large.filter("a <> b").distinct(), "links")
        parents = large.groupBy("a").agg(F.min("b").alias("low"))
        handed = large.join(parents, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        own = parents.select("a", F.col("low").alias("b"))
        current = stage(own.union(handed).distinct(), "links")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return current.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "code")
        before = state


def near_duplicates(documents: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` (smallest id reachable) per row of ``documents``.

    Needs ``doc_id, text``; other columns do not matter. Fingerprints at ``max_bits`` or fewer differing bits are linked,
    that of a text without words (zero) like any other. A null ``doc_id`` comes before all others, so the component of
    such a row has a null ``component_id``. Rows that repeat an id or a text are rows of their own with equal results.
    Equal fingerprints are merged before anything is compared, so copies add no pairs.
    """
    rows = stage(fingerprints(documents, shingle), "fingerprints")
    classes = stage(rows.groupBy("code").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(linked_codes(classes.select("code"), max_bits))
    rooted = classes.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Codes without a link are their own component: only the others need a second look.
    joined = rooted.join(named, "root").select("code", "component_id")
    return rows.join(joined, "code").select(
        id_back(), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), id_back("component_id")
    )


def first_of_each(documents: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """``documents`` with one document of each component: the one with the smallest ``doc_id``.

    Rows that repeat this id are all of the document's rows and stay; so do all rows with a null id, copies included.
    """
    found = near_duplicates(documents, max_bits, shingle)
    kept = private("kept")
    firsts = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(_key("doc_id").alias(kept)).distinct()
    return documents.join(firsts, _key("doc_id") == F.col(kept), "left_semi")


def _key(column: str) -> Column:
    return id_or_none(column)
