"""Token files and packing: equality with the tokenizer, round trips, edge rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papertrove.llm import packing, token_files
from papertrove.llm.tokens import word_encoder
from papertrove.sources import work_folder

ODD = [
    None,
    "",
    "  \n ",
    "don't. x!! a.b. 's. é. x«. the,*** y%%%",
    "<|endoftext|> X<|startoftext|>y <|x. Y.",
    "a\tB\xa0C d\x1ce\r\nf",
    "ΟΔΟΣ ΣΑΣ İstanbul e ́ x",
    "日本語 テスト ﬁ ½ a­b",
    "word " * 3000,
    "same text",
    "same text",
]


def expected(text: str | None, end_id: int) -> list[int]:
    return [*word_encoder().tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, text, "x", 1.5) for i, text in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, ids double")


def test_encoder_equals_the_tokenizer():
    ids, bounds = word_encoder().encode(pa.array(ODD), 7)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [expected(text, 7) for text in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_equals_the_tokenizer_on_any_text(texts):
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    ids, bounds = word_encoder().encode(pa.array(texts, pa.string()), 7)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [expected(text, 7) for text in texts]


def test_token_files_round_trip(spark):
    ids = [5, 3, None, 8, 1, 9, 4, 2, 7, 6, 6]
    folder = work_folder(spark, "test-tokens")
    contents = token_files.write_tokens(documents(spark, ODD, ids).repartition(3), folder, sequence=16, batch=2)
    rows = token_files.read_tokens(spark, folder).collect()
    rows.sort(key=lambda row: row["start"])
    order = sorted(zip(ids, ODD, strict=True), key=lambda pair: (pair[0] is not None, pair[0] or 0))
    assert [row["doc_id"] for row in rows] == [i for i, _ in order]
    place = 0
    for row, (_, text) in zip(rows, order, strict=True):
        assert row["ids"] == expected(text, token_files.END_ID)
        assert row["start"] == place and row["n_tokens"] == len(row["ids"])
        place += row["n_tokens"]
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in token_files.token_digests(spark, folder).collect()}
    for row in rows:
        assert digests[row["doc_id"], row["start"]] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())

    # Any sequence of a file is found by its number, and the mask covers exactly the ids.
    for file, n in contents.groupBy("file").sum("n_tokens").collect():
        opened = token_files.SequenceFile(f"{folder}/{file}")
        sequences = -(-n // 16)
        masks = [np.array(opened.sequence(i)[1]) for i in range(sequences)]
        assert sum(mask.sum() for mask in masks) == n and all(len(mask) == 16 for mask in masks)
        assert np.concatenate([opened.sequence(i)[0] for i in range(sequences)])[:n].tolist() == opened.tokens(0, n).tolist()


def test_token_files_of_no_documents(spark):
    assert token_files.encode_to_files(documents(spark, [])).collect() == []


@pytest.mark.parametrize("window", [8, 64])
def test_packing_holds_every_id_once(spark, window):
    ids = [5, 3, None, 8, 1, 9, 4, 2, 7, 6, 6]
    pieces = packing.pack(documents(spark, ODD, ids).repartition(3), window=window)
    rows = sorted(pieces.collect(), key=lambda row: (row["sequence_id"], row["offset"]))
    stream = []
    for row in rows:
        assert row["sequence_id"] * window + row["offset"] == len(stream)
        found = np.frombuffer(row["ids"], word_encoder().dtype)
        assert len(found) == row["length"] > 0 and row["offset"] + row["length"] <= window
        assert row["ids_crc32"] == zlib.crc32(found.astype("<u4").tobytes())
        stream += found.tolist()
    per_document = {}
    for row in rows:
        if row["doc_id"] != 6:
            per_document.setdefault(row["doc_id"], []).append((row["start"], np.frombuffer(row["ids"], "<u2").tolist()))
    for i, text in zip(ids, ODD, strict=True):
        if i != 6:
            assert sum((part for _, part in sorted(per_document[i])), []) == expected(text, packing.END_ID)
    assert len(stream) == sum(len(expected(text, 2)) for text in ODD)
    assert all(row["length"] == window for row in pieces.groupBy("sequence_id").sum("length").withColumnRenamed("sum(length)", "length").orderBy("sequence_id").collect()[:-1])

    joined = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert sum((np.frombuffer(row["ids"], "<u2").tolist() for row in joined), []) == stream


def test_packing_of_no_documents(spark):
    assert packing.pack(documents(spark, [])).collect() == []
