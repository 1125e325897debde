"""Removal of repeated passages of ``WINDOW`` or more words, by codes of fixed windows.

A window begins at every word and is read to ``WINDOW`` words; longer repeats are the union of adjoining windows. This
replaces a suffix tree: a node above that depth removes nothing and a deeper one nothing more, so no tree is built.
Windows are dealt out by a code of all their words, so that no phrase, however many windows it begins, makes a group
larger than others. A group fits into memory and holds a label per window, a second code of all its words; equal labels
are a repeat. All windows of a repeat but the earliest mark words to be removed; adjoining ones join into maximal repeats.

Per window, its label (8 bytes) and its place (about 2) are sent over the network, packed per slice of documents. A
repeat within a slice is settled there and sent once, so a passage that very many documents share adds no more than one
entry per slice to its group.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papertrove.llm.words import Words, id_back, id_or_none, mixed, run_codes, slices, table
from papertrove.sources import stage

WINDOW = 20
#: Windows of one group, and bytes of text of one slice and of one group of documents at the end.
GROUP_SUFFIXES = 1_500_000
SLICE_TEXT = 6 << 20
MEET_TEXT = 48 << 20
#: Bytes of text that stand for a window when groups are counted.
WORD_TEXT = 4
#: Group of the windows of documents whose rows are too many for one group; they go to several.
_SPREAD = -1

_PACKED = pa.schema(
    [("to", pa.int64()), ("meet", pa.int64())] + [(name, pa.binary()) for name in ("ids", "starts", "places", "labels")]
)
_PACKED_SQL = "to long, meet long, ids binary, starts binary, places binary, labels binary"


def labels_of(codes: np.ndarray, window: int) -> np.ndarray:
    """The label of the window at every word: a 64-bit code of all its words."""
    return run_codes(codes, window)


def dealt_by(codes: np.ndarray, window: int) -> np.ndarray:
    """What the window at every word is dealt out by, a code of all its words that does not follow from the label."""
    half = window // 2
    second = run_codes(codes[half:], window - half)
    return mixed(run_codes(codes, half)[: len(second)] + mixed(second ^ np.uint64(1)))


def text_sizes(documents: DataFrame) -> tuple[int, dict[int, int]]:
    """Bytes of all texts, and into how many parts the rows of a document are dealt if they exceed one group's text."""
    sizes = documents.groupBy("doc_id").agg(F.sum(F.octet_length("text").cast("long")).alias("size"))
    large = F.when(F.col("size") > MEET_TEXT, F.struct("doc_id", "size"))
    size, found = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.collect_list(large)).first()
    return size, {row["doc_id"]: math.ceil(row["size"] / MEET_TEXT) for row in found}


class Meets:
    """Groups in which documents meet their removed windows; rows of a document in ``heavy`` are dealt over several."""

    def __init__(self, count: int, heavy: dict[int, int]):
        self.count, self.heavy = count, heavy
        self.heavy_ids = np.array(sorted(heavy), np.int64)

    def of(self, ids: np.ndarray, part: int = 0) -> np.ndarray:
        codes = mixed(mixed(ids.astype(np.int64).view(np.uint64)) + np.uint64(part))
        return (codes % np.uint64(self.count)).astype(np.int64)

    def of_windows(self, ids: np.ndarray) -> np.ndarray:
        return np.where(np.isin(ids, self.heavy_ids), _SPREAD, self.of(ids))

    def all_of(self, doc_id: int) -> list[int]:
        """All groups that rows of the heavy document are dealt over."""
        one = np.array([doc_id])
        return sorted({int(self.of(one, part)[0]) for part in range(self.heavy[doc_id])})

    def of_row(self, doc_id: int, text: str) -> int:
        part = zlib.crc32(text.encode()) % self.heavy[doc_id]
        return int(self.of(np.array([doc_id]), part)[0])


def _meeting(to: int, where: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> Iterator[dict]:
    """Removed windows as packed rows, one per group ``where`` of documents in which they meet the texts."""
    order = np.lexsort((starts, ids, where))
    where, ids, starts = where[order], ids[order], starts[order].astype(np.int32)
    new = np.append(True, (np.diff(where) != 0) | (np.diff(ids) != 0) | (np.diff(starts) != 0))[: len(ids)]
    where, ids, starts = where[new], ids[new], starts[new]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(where) != 0)[: len(where)]), len(where))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        data = {"ids": np.diff(ids[start:end], prepend=0).tobytes(), "starts": starts[start:end].tobytes()}
        yield {"to": to, "meet": int(where[start]), "places": b"", "labels": b""} | data


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return table(_PACKED, **{name: [row[name] for row in rows] for name in _PACKED.names})


def removed_windows(documents: DataFrame, window: int, size: int, meets: Meets) -> DataFrame:
    """Windows whose words also start earlier, packed by the group ``meet`` of their documents."""
    groups = max(1, math.ceil(size / WORD_TEXT / GROUP_SUFFIXES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_TEXT):
            part = part.sort_by("doc_id").combine_chunks()
            ids = part.column("doc_id").to_numpy()
            words = Words(part.column("text"))
            codes = words.codes()
            left = np.repeat(words.bounds[1:], np.diff(words.bounds)) - np.arange(len(words))
            at = np.flatnonzero(left >= window)
            if not len(at):
                continue
            labels = labels_of(codes, window)[at]
            distinct, first, which = np.unique(labels, return_index=True, return_inverse=True)
            document = np.searchsorted(words.bounds, at, "right") - 1
            owner, start = ids[document], at - words.bounds[document]
            earliest = first[which]
            again = np.flatnonzero((owner != owner[earliest]) | (start != start[earliest]))
            rows = []
            for row in _meeting(0, meets.of_windows(owner[again]), owner[again], start[again]):
                at_will = row["meet"] if row["meet"] != _SPREAD else int(labels[0] >> np.uint64(1))
                rows.append(row | {"to": at_will % groups})
            first.sort()
            to = (dealt_by(codes, window)[at[first]] % np.uint64(groups)).astype(np.int64)
            order = first[np.argsort(to, kind="stable")]
            to.sort()
            edges = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                some = order[low:high]
                used, place = np.unique(document[some], return_inverse=True)
                gaps = np.diff(at[some], prepend=0)
                width = np.uint16 if gaps.max() < 1 << 16 else np.uint32
                rows.append(
                    {
                        "to": int(to[low]),
                        "meet": None,
                        "ids": np.diff(ids[used], prepend=0).tobytes(),
                        "starts": np.diff(words.bounds[used], prepend=0).astype(np.uint32).tobytes(),
                        "places": gaps.astype(width).tobytes(),
                        "labels": labels[some].tobytes(),
                    }
                )
            yield _batch(rows)

    def build(group: pa.Table) -> pa.Table:
        rows, label, owner, start = [], [], [], []
        for row in group.to_pylist():
            if row["meet"] is not None:
                rows.append(row)
                continue
            found = np.frombuffer(row["labels"], np.uint64)
            width = np.uint16 if len(row["places"]) == 2 * len(found) else np.uint32
            at = np.cumsum(np.frombuffer(row["places"], width), dtype=np.int64)
            bounds = np.cumsum(np.frombuffer(row["starts"], np.uint32), dtype=np.int64)
            document = np.searchsorted(bounds, at, "right") - 1
            label.append(found)
            owner.append(np.cumsum(np.frombuffer(row["ids"], np.int64))[document])
            start.append((at - bounds[document]).astype(np.int32))
        if label:
            ids, starts = repeated_windows(*map(np.concatenate, (label, owner, start)))
            rows += _meeting(0, meets.of_windows(ids), ids, starts)
        return pa.Table.from_batches([_batch(rows)])

    dealt = documents.mapInArrow(deal, _PACKED_SQL)
    return dealt.groupBy("to").applyInArrow(build, _PACKED_SQL).select("meet", "ids", "starts")


def spread_windows(removed: DataFrame, meets: Meets) -> DataFrame:
    """``removed`` with the windows of heavy documents, each start once, in all groups that hold their rows."""
    pair = pa.schema([("doc_id", pa.int64()), ("start", pa.int32())])
    packed = pa.schema([("meet", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.cumsum(np.frombuffer(row["ids"], np.int64))
                yield table(pair, doc_id=ids, start=np.frombuffer(row["starts"], np.int32))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy()
            for doc_id in np.unique(ids).tolist():
                mine = ids == doc_id
                for meet in meets.all_of(doc_id):
                    rows = list(_meeting(0, np.full(mine.sum(), meet), ids[mine], starts[mine]))
                    yield table(packed, **{name: [row[name] for row in rows] for name in packed.names})

    removed = stage(removed, "repeats")
    heavy = removed.where(F.col("meet") == _SPREAD).mapInArrow(unpack, "doc_id long, start int").distinct()
    spread = heavy.mapInArrow(pack, "meet long, ids binary, starts binary")
    return removed.where(F.col("meet") != _SPREAD).unionByName(spread)


def repeated_windows(label: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and start of all windows of a group that have the label of an earlier one."""
    order = np.argsort(label)
    ordered = label[order]
    same = ordered[1:] == ordered[:-1]
    inside = np.append(same, False) | np.append(False, same)
    windows = order[inside]
    windows = windows[np.lexsort((start[windows], owner[windows], label[windows]))]
    if not len(windows):
        return owner[:0], start[:0]
    new = np.append(True, label[windows[1:]] != label[windows[:-1]])
    earliest = windows[np.flatnonzero(new)[np.cumsum(new) - 1]]
    again = windows[(owner[windows] != owner[earliest]) | (start[windows] != start[earliest])]
    return owner[again], start[again]


def remove_repeats(documents: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``n_words, n_removed, kept_sha256`` and, with ``with_text``, the kept
    words joined by spaces as ``text`` and the removed ``spans`` (words; start, end, start, ...).

    A word is removed if a window of ``window`` words of its document covers it whose words also start earlier (in a
    document with a smaller ``doc_id``, or earlier in the same one). All windows are judged on the input. Texts of fewer
    words than a window, empty and null ones lose nothing. A null ``doc_id`` comes before all others. Rows that repeat a
    ``doc_id`` are one document read several times: equal rows do not remove each other, and a word is removed from all
    of them where any of them loses it. Other columns do not matter.
    """
    rows = documents.select(id_or_none(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size, heavy = text_sizes(rows)
    meets = Meets(max(1, math.ceil(size / MEET_TEXT)), heavy)
    removed = removed_windows(rows, window, size, meets)
    if heavy:
        removed = spread_windows(removed, meets)
    shrunk = pa.schema([("meet", pa.int64()), ("doc_id", pa.int64()), ("data", pa.binary()), ("copies", pa.int64())])
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("text", pa.string()), ("spans", pa.list_(pa.int64()))] if with_text else []
    schema = pa.schema(fields)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for part in slices(batches, "text", SLICE_TEXT):
            ids, texts = part.column("doc_id").to_numpy(), part.column("text").to_pylist()
            where, copies = meets.of(ids), np.ones(len(ids), np.int64)
            # Equal rows of a heavy document are sent once per slice.
            seen: dict[tuple[int, str], int] = {}
            for at in np.flatnonzero(np.isin(ids, meets.heavy_ids)).tolist():
                key = int(ids[at]), texts[at]
                first = seen.setdefault(key, at)
                if first != at:
                    copies[first] += 1
                    copies[at] = 0
                where[at] = meets.of_row(*key)
            sent = np.flatnonzero(copies)
            data = [pack(texts[at].encode()) for at in sent.tolist()]
            yield table(shrunk, meet=where[sent], doc_id=ids[sent], data=data, copies=copies[sent])

    def meet(texts: pa.Table, windows: pa.Table) -> pa.Table:
        ids, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for row in windows.select(["ids", "starts"]).to_pylist():
            ids.append(np.cumsum(np.frombuffer(row["ids"], np.int64)))
            starts.append(np.frombuffer(row["starts"], np.int32))
        owners, begins = np.concatenate(ids), np.concatenate(starts)
        order = np.argsort(owners, kind="stable")
        owners, begins = owners[order], begins[order]
        unpack = zstandard.ZstdDecompressor().decompress
        out: dict[str, list] = {name: [] for name in schema.names}
        for doc_id, data, copies in zip(*(texts.column(name).to_pylist() for name in shrunk.names[1:]), strict=True):
            words = unpack(data).split() if data else []
            low, high = np.searchsorted(owners, [doc_id, doc_id + 1])
            spans = _spans(begins[low:high], window, len(words))
            kept, at = [], 0
            for start, end in spans:
                kept += words[at:start]
                at = end
            kept += words[at:]
            text = b" ".join(kept)
            values = [doc_id, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest()]
            values += [text.decode(), [edge for span in spans for edge in span]] if with_text else []
            for name, value in zip(schema.names, values, strict=True):
                out[name] += [value] * copies
        return pa.Table.from_batches([table(schema, **out)])

    left = rows.mapInArrow(shrink, "meet long, doc_id long, data binary, copies long").groupBy("meet")
    kinds = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    kinds += ", text string, spans array<long>" if with_text else ""
    met = left.cogroup(removed.groupBy("meet")).applyInArrow(meet, kinds)
    return met.select(id_back(), *met.columns[1:])


def _spans(begins: np.ndarray, window: int, words: int) -> list[tuple[int, int]]:
    """Joined spans of the windows at ``begins`` inside a text of so many words."""
    begins = np.unique(begins[begins + window <= words])
    if not len(begins):
        return []
    new = np.append(True, np.diff(begins) > window)
    firsts = begins[new]
    lasts = begins[np.append(np.flatnonzero(new)[1:] - 1, len(begins) - 1)] + window
    return list(zip(firsts.tolist(), lasts.tolist(), strict=True))
