"""Benchmark decontamination by multi-pattern search (Wu and Manber), over words.

The patterns are the benchmark's windows. A text is read in jumps: the block of two words at the end of the current
alignment says how far the search may move on without missing a window (the shift table). Only where the shift is zero
the block's bucket, split by a code of the whole suffix, names the few windows that are compared word by word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from papertrove.sources import stage

WINDOW = 13
BLOCK = 2
#: Windows that one pass over the documents searches for; more of them take more passes.
PASS_WINDOWS = 200_000
_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_UPPER = bytes(range(0x41, 0x5B))
_FOLD = bytes(
    c + 32 if c in _UPPER else 32 if c in _SEPARATORS else c for c in range(256)
)

Pattern = tuple[bytes, ...]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case: runs of digits, a-z and characters beyond ASCII; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(text: str | None, size: int = WINDOW) -> list[Pattern]:
    """Windows of ``size`` consecutive words; a shorter text with words is one window."""
    found = words_of(text)
    return [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))] if found else []


class Search:
    """Shift table and suffix buckets of patterns of one length; a pattern has the items it comes from."""

    def __init__(self, patterns: dict[Pattern, list[str]], length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.far = length - self.block + 1
        self.shift: dict[Pattern, int] = {}
        self.buckets: dict[int, list[tuple[Pattern, list[str]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                piece = pattern[end - self.block : end]
                self.shift[piece] = min(self.shift.get(piece, self.far), length - end)
            self.buckets.setdefault(hash(pattern[length // 2 :]), []).append((pattern, items))

    def occurrences(self, found: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of every occurrence in the words, with the items of the window."""
        m, b, far, shift, total = self.length, self.block, self.far, self.shift.get, len(found)
        end = m
        while end <= total:
            jump = shift(tuple(found[end - b : end]), far)
            if jump:
                end += jump
                continue
            start = end - m
            for pattern, items in self.buckets.get(hash(tuple(found[start + m // 2 : end])), ()):
                if tuple(found[start:end]) == pattern:
                    yield start, items
            end += 1


def searches(windows: list[tuple[Pattern, str]]) -> list[Search]:
    """One search for the windows of each length."""
    by_length: dict[int, dict[Pattern, list[str]]] = {}
    for pattern, item in windows:
        items = by_length.setdefault(len(pattern), {}).setdefault(pattern, [])
        if item not in items:
            items.append(item)
    return [Search(patterns, length) for length, patterns in sorted(by_length.items())]


def hits(found: list[bytes], tables: list[Search]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans of words inside occurrences, in order, and the items that occur."""
    spans, items = [], set()
    for one in tables:
        for start, names in one.occurrences(found):
            spans.append((start, start + one.length))
            items.update(names)
    return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(IntegerType())),
        StructField("items", ArrayType(StringType())),
    ]
)


def with_windows(documents: DataFrame, benchmark: DataFrame, column: str, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """``documents`` with a struct ``column``: ``n_words``, ``spans`` and ``items`` of the row's ``text``.

    ``spans`` are merged word spans inside benchmark windows as start, end, start, end, ...; ``items`` are the sorted ids
    of the items that occur. ``benchmark`` needs ``item_id, text``; a null id is an item called "null", items may repeat,
    and those without words have no windows. A null or empty text has no words and no spans.

    The benchmark is read in blocks of at most ``pass_windows`` windows, each of which the tasks get as one bounded
    table. Its size is not limited: each block is one more pass, which adds to what the passes before it found.
    """
    found = documents.withColumn(
        column,
        F.struct(
            F.lit(0).cast("long").alias("n_words"),
            F.array().cast("array<int>").alias("spans"),
            F.array().cast("array<string>").alias("items"),
        ),
    )
    block: list[tuple[Pattern, str]] = []
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        for pattern in windows_of(text):
            if len(block) >= pass_windows:
                found = stage(_one_pass(found, block, column), "decontaminate")
                block = []
            block.append((pattern, item))
    return _one_pass(found, block, column)


def _one_pass(documents: DataFrame, windows: list[tuple[Pattern, str]], column: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(windows)
    tables: list[Search] = []

    @F.pandas_udf(_FOUND)
    def search(texts: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        if not tables:
            tables.extend(searches(shared.value))
        rows = []
        for text, before, known in zip(texts, spans, items, strict=True):
            found = words_of(text)
            at, names = hits(found, tables)
            at = merged([*at, *zip(before[::2], before[1::2], strict=True)])
            rows.append((len(found), [int(edge) for span in at for edge in span], sorted({*names, *known})))
        return pd.DataFrame(rows, columns=_FOUND.names)

    before = F.col(column)
    return documents.withColumn(column, search(F.col("text").cast("string"), before["spans"], before["items"]))


def _n_hit(found: Column) -> Column:
    signed = F.transform(found["spans"], lambda edge, i: F.when(i % 2 == 1, edge).otherwise(-edge))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, edge: total + edge)


def _contaminated(found: Column) -> Column:
    n_hit = _n_hit(found)
    return (n_hit > 0) & (20 * n_hit >= found["n_words"])


def contamination(documents: DataFrame, benchmark: DataFrame, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): words, words inside benchmark windows, the items that occur, and
    whether at least one word in twenty is hit.

    Nulls, empty texts and further columns are treated as in ``with_windows``; without words a document is not
    contaminated. Rows that repeat a ``doc_id`` are searched one by one, and a null ``doc_id`` stays null.
    """
    kept = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = F.col("found")
    return with_windows(kept, benchmark, "found", pass_windows).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        _n_hit(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        _contaminated(found).alias("contaminated"),
        found["items"].alias("items"),
        found["spans"].alias("spans"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns."""
    found = f"found_{uuid.uuid4().hex}"
    searched = with_windows(documents, benchmark, found, pass_windows)
    return searched.filter(~_contaminated(F.col(found))).drop(found)
