"""Token ids as Arrow stream files of equal-length sequences.

Documents are ordered by id, encoded and cut into sequences of one length. Every file holds record batches with a
fixed-size list of ids and one of mask bits per sequence, so a sequence lies at a computed place and is read without a
copy from a memory map. The last sequence of a file is filled up with zeros that the mask leaves out.

A table of contents (one row per document: file, place in the file, number of tokens) is written beside the files. It is
written last and names the files of successful attempts only, so those of a lost or repeated task are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.llm.tokens import SLICE_TEXT, WORD_BPE, word_encoder
from papertrove.llm.words import slices, table
from papertrove.sources.storage import default_file_system, open_folder, work_folder

SEQUENCE = 2048
BATCH = 64
END_ID = 1
_CONTENTS = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())]
)


def file_schema(sequence: int, ids: np.dtype) -> pa.Schema:
    value = pa.field("item", pa.from_numpy_dtype(ids), nullable=False)
    bit = pa.field("item", pa.bool_(), nullable=False)
    return pa.schema([pa.field("ids", pa.list_(value, sequence)), pa.field("mask", pa.list_(bit, sequence))])


class SequenceWriter:
    """Collects ids and writes full batches; never holds more than one batch and the last piece given."""

    def __init__(self, sink, sequence: int, batch: int, ids: np.dtype):
        self.sequence, self.batch, self.ids = sequence, batch, ids
        self.schema = file_schema(sequence, ids)
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held = bytearray()
        self.written = 0

    @property
    def tokens(self) -> int:
        return self.written + len(self.held) // self.ids.itemsize

    def add(self, data: bytes) -> None:
        self.held += data
        full = self.sequence * self.batch * self.ids.itemsize
        whole = len(self.held) // full * full
        for at in range(0, whole, full):
            self._write(np.frombuffer(bytes(self.held[at : at + full]), self.ids))
        del self.held[:whole]

    def _write(self, ids: np.ndarray) -> None:
        self.written += len(ids)
        mask = np.ones(len(ids), bool)
        if rest := -len(ids) % self.sequence:
            ids, mask = np.append(ids, np.zeros(rest, ids.dtype)), np.append(mask, np.zeros(rest, bool))
        values = [
            pa.FixedSizeListArray.from_arrays(pa.array(column, field.type.value_type), type=field.type)
            for column, field in zip((ids, mask), self.schema, strict=True)
        ]
        self.out.write_batch(pa.RecordBatch.from_arrays(values, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.frombuffer(bytes(self.held), self.ids))
        self.out.close()


class SequenceFile:
    """Reads one file; ``sequence(i)`` and ``tokens(start, count)`` are views of the mapped file where they can be."""

    def __init__(self, path: str, default: str = "file:///"):
        files, inside = open_folder(path, default)
        local = isinstance(files, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(inside) if local else pa.BufferReader(files.open_input_file(inside).read_buffer())
        reader = pa.ipc.open_stream(self.source)
        self.length = reader.schema.field("ids").type.list_size
        self.batches = [batch for batch in reader]
        self.rows = self.batches[0].num_rows if self.batches else 1

    def sequence(self, index: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of a sequence; every batch but the last has the same number of rows."""
        batch, row = self.batches[index // self.rows], index % self.rows
        return self._ids(index // self.rows)[row * self.length : (row + 1) * self.length], batch.column("mask")[row].values

    def tokens(self, start: int, count: int) -> np.ndarray:
        size = self.rows * self.length
        parts = []
        while count > 0:
            part = self._ids(start // size)[start % size : start % size + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else self._empty()

    def _ids(self, batch: int) -> np.ndarray:
        return self.batches[batch].column("ids").flatten().to_numpy(zero_copy_only=True)

    def _empty(self) -> np.ndarray:
        return np.zeros(0, np.uint32)


def write_tokens(
    documents: DataFrame,
    folder: str,
    vocabulary: str = WORD_BPE,
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    batch: int = BATCH,
) -> DataFrame:
    """Write all ids of ``documents`` (``doc_id, text``) below ``folder`` and return its table of contents.

    Documents are in ascending ``doc_id`` order, over all files too (null ids first; rows that repeat an id follow each
    other by text and each count as a document). A null or empty text is the end id alone. No documents: no files.
    Splitting is by (id, hash of text), so one id with very many rows is spread over tasks as well.
    """
    spark = documents.sparkSession
    default = default_file_system(spark)
    ordered = (
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = word_encoder(vocabulary)
        writer, sink = None, None
        for piece in slices(batches, "text", SLICE_TEXT):
            if writer is None:
                files, inside = open_folder(folder, default)
                files.create_dir(inside, recursive=True)
                name = f"{part:06d}-{uuid.uuid4().hex}.arrows"
                sink = files.open_output_stream(f"{inside}/{name}")
                writer = SequenceWriter(sink, sequence, batch, encoder.dtype)
            ids, bounds = encoder.encode(piece.column("text"), end_id)
            at = writer.tokens + bounds[:-1]
            writer.add(ids.tobytes())
            rows = len(at)
            doc_ids = piece.column("doc_id").combine_chunks()
            yield table(
                _CONTENTS, part=[part] * rows, file=[name] * rows, doc_id=doc_ids, at=at, n_tokens=np.diff(bounds)
            )
        if writer is not None:
            writer.close()
            sink.close()

    contents = ordered.mapInArrow(write, "part int, file string, doc_id long, at long, n_tokens long")
    contents.write.parquet(f"{folder}/contents")
    return spark.read.parquet(f"{folder}/contents")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a written folder: ``doc_id, start`` (tokens of all documents before it), ``n_tokens, ids``."""
    return _read(spark, folder, "ids array<long>", pa.list_(pa.int64()), lambda ids: ids.astype(np.int64))


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_tokens`` with ``ids_crc32`` instead of the ids: crc32 over little-endian unsigned 32-bit ids."""
    return _read(spark, folder, "ids_crc32 long", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _read(spark: SparkSession, folder: str, column: str, kind: pa.DataType, of) -> DataFrame:
    contents = spark.read.parquet(f"{folder}/contents")
    # One row per file: the files' lengths, added up in order, give the number of tokens before each file.
    totals = contents.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = dict(zip((r["part"] for r in totals), np.cumsum([0] + [r["n"] for r in totals]).tolist(), strict=False))
    name = column.split()[0]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])
    default = default_file_system(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, opened = None, None
        for rows in batches:
            start, found = [], []
            for row in rows.select(["part", "file", "at", "n_tokens"]).to_pylist():
                if row["file"] != current:
                    current, opened = row["file"], SequenceFile(f"{folder}/{row['file']}", default)
                start.append(before[row["part"]] + row["at"])
                found.append(of(opened.tokens(row["at"], row["n_tokens"])))
            yield table(schema, doc_id=rows.column("doc_id"), start=start, n_tokens=rows.column("n_tokens"), **{name: found})

    return contents.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def encode_to_files(documents: DataFrame, vocabulary: str = WORD_BPE, end_id: int = END_ID) -> DataFrame:
    """Write the token files into a new shared folder and read every document's digest back from them."""
    spark = documents.sparkSession
    folder = work_folder(spark, "token-files")
    write_tokens(documents, folder, vocabulary, end_id)
    return token_digests(spark, folder)
