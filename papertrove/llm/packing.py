"""Packing by concatenating and cutting.

All token ids form one stream. A first pass encodes the documents and counts tokens per partition; a running sum over
these totals gives every partition its place in the stream. A second pass cuts the stream into windows of one length and
records the pieces, their documents and their boundaries. Only the last window of the stream is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papertrove.llm.tokens import SLICE_TEXT, WORD_BPE, word_encoder
from papertrove.llm.words import slices, table
from papertrove.sources import stage

WINDOW = 4096
END_ID = 2
_STREAM = pa.schema(
    [("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)
_PIECES = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def token_stream(documents: DataFrame, vocabulary: str = WORD_BPE, end_id: int = END_ID) -> DataFrame:
    """Ids of every row (little-endian, of the vocabulary's narrowest type) with the place within its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        encoder = word_encoder(vocabulary)
        for piece in slices(batches, "text", SLICE_TEXT):
            ids, bounds = encoder.encode(piece.column("text"), end_id)
            held = pa.py_buffer(ids)
            data = pa.Array.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds * encoder.dtype.itemsize), held]
            )
            places = at + bounds
            at = int(places[-1])
            doc_ids = piece.column("doc_id").combine_chunks()
            counts = np.diff(bounds)
            yield table(
                _STREAM, part=[part] * len(counts), at=places[:-1], doc_id=doc_ids, n_tokens=counts, ids=data.cast(pa.binary())
            )

    kept = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return kept.mapInArrow(encode, "part int, at long, doc_id long, n_tokens long, ids binary")


def pack(
    documents: DataFrame, window: int = WINDOW, vocabulary: str = WORD_BPE, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents (``doc_id, text``) in sequences of ``window`` tokens.

    Per piece: ``doc_id, start`` (ids of its document before it), ``length, ids_crc32`` (over little-endian unsigned
    32-bit ids), ``doc_tokens, sequence_id, offset`` and, with ``with_ids``, its ``ids`` as little-endian bytes. A null
    or empty text is one piece, the end id. Null and repeated ``doc_id`` values are carried along, row by row. A text of
    any length may run over many sequences. No documents: no pieces.
    """
    # Written once, so that both passes see the same partitions even if a task is repeated.
    stream = stage(token_stream(documents, vocabulary, end_id), "token-stream")
    totals = stream.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = dict(zip((r["part"] for r in totals), np.cumsum([0] + [r["n"] for r in totals]).tolist(), strict=False))
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = word_encoder(vocabulary).dtype
        for rows in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for row in rows.to_pylist():
                ids = np.frombuffer(row["ids"], dtype)
                place = before[row["part"]] + row["at"]
                edges = [0, *range(window - place % window, len(ids), window), len(ids)]
                for start, end in zip(edges[:-1], edges[1:], strict=True):
                    wide = ids[start:end].astype("<u4").tobytes()
                    values = (row["doc_id"], start, end - start, zlib.crc32(wide), len(ids))
                    values += ((place + start) // window, (place + start) % window)
                    for name, value in zip(_PIECES.names, values, strict=True):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(ids[start:end].tobytes())
            yield table(schema, **out)

    kinds = ", ".join(f"{name} long" for name in _PIECES.names) + (", ids binary" if with_ids else "")
    return stream.mapInArrow(cut, kinds)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids joined in order and its boundary records; a group never exceeds one window."""
    part = F.struct("offset", "length", "doc_id", "start", "ids")
    parts = F.array_sort(F.collect_list(part))
    ids = F.aggregate("parts", F.lit(b""), lambda done, one: F.concat(done, one["ids"]))
    boundaries = F.transform("parts", lambda p: F.struct(p["offset"], p["length"], p["doc_id"], p["start"]))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", ids.alias("ids"), boundaries.alias("boundaries")
    )
