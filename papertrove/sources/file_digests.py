"""Digests of whole files by tasks that read a bounded part of one.

``binaryFile`` gives a file as one row, so one task reads it whole, and refuses files over 2 GB. Here only files of up to
``PIECE`` bytes are read that way. Longer ones are read as lines, which Spark splits, and staged as pieces; their digests
then go from piece to piece, in as many rounds as the longest file has pieces, all files at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papertrove.functions import md5
from papertrove.session import arrow_batch
from papertrove.sources.files import scan_binary, scan_lines
from papertrove.sources.storage import stage, work_folder

# A task reads this much of a file in a round, and up to one split of the session (128 MB by default) more.
PIECE = 128 << 20
# Small rows and row groups keep the Parquet writer from holding a whole split.
_BLOCK, _ROW_GROUP, _BATCH_ROWS = 128 << 10, 16 << 20, 64
# Spark unpacks such files when it reads lines; they are read whole whatever their length.
_PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"
_MARK = b"\xef\xbb\xbf"
_BLOCKS = "file string, start long, place long, n_bytes long, block binary"
_STATE = "file string, number int, length long, surplus long, `left` long, chain binary, tail binary, digest string"
_STATE_FIELDS = pa.schema([
    ("file", pa.string()), ("number", pa.int32()), ("length", pa.int64()), ("surplus", pa.int64()), ("left", pa.int64()),
    ("chain", pa.binary()), ("tail", pa.binary()), ("digest", pa.string()),
])


def file_digests(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, length, digest)`` of every file that ``scan_binary`` lists; the digest is the MD5 of all its bytes."""
    files = scan_binary(spark, path, glob)
    whole = files.where(~_in_pieces()).select("path", "length", F.md5("content").alias("digest"))
    # No file is opened for this.
    long = files.where(_in_pieces()).select(F.col("_metadata.file_path").alias("file"), "path", "length")
    longest = long.agg(F.max("length")).first()[0]
    if longest is None:
        return whole
    digests = _digests_by_pieces(scan_lines(spark, path, glob).where(_in_pieces()), long, longest)
    return whole.unionByName(long.join(digests, "file").select("path", "length", "digest"))


def _in_pieces() -> Column:
    """Known from the listing, so a scan that filters by it leaves the other files closed."""
    return (F.col("_metadata.file_size") > PIECE) & ~F.col("_metadata.file_name").rlike(_PACKED)


def _staged_blocks(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """The bytes that the lines come from, in blocks by the round that they are digested in."""
    parts = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )
    blocks = parts.mapInArrow(_join_lines, _BLOCKS).join(F.broadcast(numbers.select("file", "number")), "file")
    blocks = blocks.withColumn("round", F.floor(F.col("start") / PIECE).cast("int"))
    folder = work_folder(lines.sparkSession, "file-blocks")
    blocks.write.partitionBy("round").option("parquet.block.size", _ROW_GROUP).parquet(folder)
    return lines.sparkSession.read.schema(blocks.schema).parquet(folder)


def _digests_by_pieces(lines: DataFrame, files: DataFrame, longest: int) -> DataFrame:
    # Names and lengths alone; there are as many numbers as long files.
    numbers = files.withColumn("number", F.row_number().over(W.orderBy(F.desc("length"), "file")) - 1)
    numbers = stage(numbers, "long-files")
    blocks = _staged_blocks(lines, numbers)
    sizes = blocks.groupBy("file").agg(F.sum("n_bytes").alias("n_bytes"))
    states = numbers.join(sizes, "file", "left").select(
        "file", "number", "length", (F.coalesce("n_bytes", F.lit(0)) - F.col("length")).alias("surplus"),
        F.col("length").alias("left"), F.lit(md5.START).alias("chain"), F.lit(b"").alias("tail"),
        F.lit(None).cast("string").alias("digest"),
    )
    states = stage(states, "file-digests")
    for number in range((longest - 1) // PIECE + 1):
        # The longest files have the lowest numbers, so the ones that go on are numbered without gaps: one task each.
        goes_on = F.col("length") > number * PIECE
        piece = blocks.where(F.col("round") == number).select("file", "number", "start", "place", "block")
        rows = states.where(goes_on).withColumn("start", F.lit(-1)).unionByName(piece, allowMissingColumns=True)
        rows = rows.repartitionById(states.where(goes_on).count(), "number").sortWithinPartitions("file", "start", "place")
        done = rows.mapInArrow(_digest_on, _STATE).unionByName(states.where(~goes_on))
        with arrow_batch(lines.sparkSession, _BATCH_ROWS):
            states = stage(done, "file-digests")
    return states.select("file", "digest")


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of every split, each with its line feed again, cut into blocks."""
    place = 0
    for batch in batches:
        begin = 0
        for end in _run_ends(batch):
            about = {name: batch.column(name)[begin].as_py() for name in ("file", "start")}
            data = b"\n".join([*batch.column("line").slice(begin, end - begin).to_pylist(), b""])
            blocks = [data[at : at + _BLOCK] for at in range(0, len(data), _BLOCK)]
            rows = [about | {"place": place + i, "n_bytes": len(block), "block": block} for i, block in enumerate(blocks)]
            yield pa.RecordBatch.from_pylist(rows)
            begin, place = end, place + len(blocks)


def _run_ends(batch: pa.RecordBatch) -> list[int]:
    """Where neighbouring rows of the same split end."""
    if batch.num_rows == 0:
        return []
    changes = [pc.not_equal(batch.column(name)[1:], batch.column(name)[:-1]) for name in ("file", "start")]
    return [*(np.flatnonzero(pc.or_(*changes)) + 1).tolist(), batch.num_rows]


def _digest_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state of every file after its blocks of one round, which come behind the state in the order of the file."""
    state: dict[str, Any] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["start"] >= 0:
                _add(state, row["block"])
                continue
            if state is not None:
                yield _ended(state)
            state = {name: row[name] for name in _STATE_FIELDS.names}
            # Lines leave out a byte order mark at the file's beginning; a last line without a line feed has got one.
            if state["surplus"] not in (0, 1, -3, -2):
                raise ValueError(f"{state['file']}: {state['length']} bytes listed, {state['surplus']} more read")
            if state["surplus"] < 0 and state["left"] == state["length"]:
                _add(state, _MARK)
    if state is not None:
        yield _ended(state)


def _add(state: dict[str, Any], data: bytes) -> None:
    data = data[: state["left"]]
    state["chain"], state["tail"] = md5.go_on(state["chain"], state["tail"], data)
    state["left"] -= len(data)


def _ended(state: dict[str, Any]) -> pa.RecordBatch:
    if state["left"] == 0:
        state["digest"] = md5.digest(state["chain"], state["tail"], state["length"])
    return pa.RecordBatch.from_pylist([state], _STATE_FIELDS)
