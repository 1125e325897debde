"""Whole jobs over files: folders to tables, saved images, answers."""

from __future__ import annotations

import struct
import uuid

import pytest
from pyspark.sql import functions as F

from papertrove.config import CLASS_NAMES, RESULT_COLUMNS, read_settings
from papertrove.operators import assets, search
from papertrove.plans import jobs
from papertrove.session import ARROW_ROWS, arrow_batch
from papertrove.sources import class_prompts, scan_binary, source_path, stage, work_folder

SETTINGS = {
    "data": {"image_path": "/i", "document_path": "/d", "source_table_name": "t", "primary_key": "id"},
    "retriever": {
        "primary_key": "id", "embedding_source_column": "content", "columns": ["id", "source_path"],
        "search_parameters": {"k": 2},
    },
    "classifications": [{"name": "default", "prompt": "D"}, {"name": "map", "prompt": None}],
}


def test_settings():
    found = read_settings(SETTINGS)
    assert (found.primary_key, found.top_k, found.classes) == ("id", 2, (("default", "D"), ("map", None)))
    with pytest.raises(ValueError, match="document_path"):
        read_settings({**SETTINGS, "data": {"primary_key": "id"}})
    with pytest.raises(ValueError, match="differ"):
        read_settings({**SETTINGS, "retriever": {"primary_key": "other"}})
    assert read_settings({**SETTINGS, "retriever": {"embedding_source_column": "content"}}).top_k == 3
    assert len(CLASS_NAMES) == 12 and len(RESULT_COLUMNS) == 12


def test_class_prompts_keep_the_first(spark):
    rows = class_prompts(spark, [("a", "1"), ("b", None), ("a", "2")]).collect()
    assert sorted(map(tuple, rows), key=str) == [("a", "1"), ("b", None)]


@pytest.mark.parametrize(
    "path,plain", [("file:///a/b", "/a/b"), ("file:/a/b", "/a/b"), ("s3a://bucket/b", "/bucket/b"), ("/a:/b", "/a:/b")]
)
def test_source_path(spark, path, plain):
    assert spark.range(1).select(source_path(F.lit(path))).first()[0] == plain


def test_arrow_batch_comes_back(spark):
    before = spark.conf.get(ARROW_ROWS)
    with pytest.raises(RuntimeError):
        with arrow_batch(spark, 10):
            assert spark.conf.get(ARROW_ROWS) == "10"
            raise RuntimeError
    assert spark.conf.get(ARROW_ROWS) == before


def test_stage_writes_once_to_the_shared_folder(spark):
    rows = stage(spark.range(10).withColumn("r", F.rand()), "once")
    assert rows.collect() == rows.collect()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert work_folder(spark, "x").startswith(shared.rstrip("/") + "/x-")


@pytest.fixture
def folder(tmp_path):
    docs = tmp_path / "docs" / "below"
    docs.mkdir(parents=True)
    (docs / "page.html").write_text("<html><h1>Cats</h1>" + "<p>the cat sat on the mat</p>" * 100 + "</html>")
    (docs / "plain.txt").write_text("dogs bark\fsecond page about dogs")
    (docs / "blank.txt").write_text("  \n ")
    (docs / "scan.pdf").write_bytes(b"%PDF-1.7 binary")
    return tmp_path


def test_scan_limits(spark, folder):
    files = scan_binary(spark, f"{folder}/docs")
    assert files.count() == 4
    assert scan_binary(spark, f"{folder}/docs", "*.txt").count() == 2


def test_document_index_and_question(spark, folder):
    table = f"docs_{uuid.uuid4().hex}"
    index = jobs.build_document_index(spark, f"{folder}/docs", table, f"{folder}/tables")
    assert index.columns == ["id", "source_path", "chunk_index", "content"]
    rows = index.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    assert {r.source_path.rpartition("/")[2] for r in rows} == {"page.html", "plain.txt"}
    assert all(len(r.content) <= 1000 for r in rows)

    again = jobs.build_document_index(spark, f"{folder}/docs", table, f"{folder}/tables")
    assert again.orderBy("id").collect() == rows

    answers = jobs.ask(search.embed_text(index, "content"), "which dogs bark", read_settings(SETTINGS)).collect()
    assert len(answers) == 2 and answers[0].source_path.endswith("plain.txt")
    assert answers[0].__fields__ == ["id", "source_path", "score"]


def test_page_chunks(spark, folder):
    rows = jobs.page_chunks(spark, f"{folder}/docs", "*.txt").collect()
    assert [(r.page_number, r.chunk_index, r.chunks) for r in rows] == [
        (1, 0, "dogs bark"), (2, 0, "second page about dogs")
    ]


def test_image_index(spark, folder):
    images = folder / "images"
    images.mkdir()
    for i in range(5):
        header = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">II", 1000 + 100 * i, 10)
        (images / f"p{i}.png").write_bytes(header + b"\x08\x02" + bytes(i))
    (images / "notes.txt").write_text("no image")
    classes = [("default", "Be brief."), ("map", None)]
    log = folder / "calls"
    log.mkdir()

    def captioner():
        def caption(content):
            (log / uuid.uuid4().hex).touch()
            return f"{len(content)} bytes"

        return caption

    def classifier():
        return lambda url, names: names[1] if len(url) % 8 else "not in the list"

    def summarizer():
        def summary(prompt, url):
            if prompt is None:
                raise ValueError("no class")
            return f"{prompt}|{url[:22]}"

        return summary

    table = f"images_{uuid.uuid4().hex}"
    index, report = jobs.build_image_index(
        spark, f"{images}", f"{folder}/saved", table, f"{folder}/tables", classes, captioner, classifier, summarizer
    )
    assert index.columns[:2] == ["id", "source_path"] and index.columns[-1] == "content"
    rows = index.orderBy("id").collect()
    index.count()
    assert len(list(log.iterdir())) == 5
    assert [r.image_caption for r in rows] == [f"{26 + i} bytes" for i in range(5)]
    assert [r.original_image_size for r in rows] == [[1000 + 100 * i, 10] for i in range(5)]
    for row in rows:
        if row.image_classification is None:
            assert row.content is None
        else:
            want = "Summarize this image of a map using the provided tools. Instructions: Be brief.|data:image/png;base64,"
            assert row.content == want
    assert {r.status for r in report.collect()} == {"success"}
    assert sorted(p.name for p in (folder / "saved").iterdir()) == sorted(r.image_path.rpartition("/")[2] for r in rows)


def test_index_follows_a_table(spark, tmp_path):
    from papertrove.streaming.sync import open_index

    schema = "source_path string, chunk_index int, content string"
    first = spark.createDataFrame([("a", 0, "a dog"), ("a", 1, "a cat"), ("b", 0, "a cow")], schema)
    second = spark.createDataFrame([("a", 0, "a dog"), ("b", 0, "two cows"), ("c", 0, "a hen")], schema)
    index = open_index(f"{tmp_path}/index", ["source_path", "chunk_index"], "version")
    feed = f"{tmp_path}/feed"
    for version, (old, new) in enumerate([(None, first), (first, second), (second, second)]):
        jobs.follow_table(old, new, index, feed, version)
        live = index.read(spark).select(*new.columns).collect()
        assert sorted(map(tuple, live)) == sorted(map(tuple, new.collect()))
    versions = {(r.source_path, r.version) for r in index.read(spark).collect()}
    assert versions == {("a", 0), ("b", 1), ("c", 1)}


def test_image_scoring_stages_no_encoded_bytes(spark, monkeypatch):
    staged = []
    keep = jobs.stage
    monkeypatch.setattr(jobs, "stage", lambda df, *rest: (staged.append(df.columns), keep(df, *rest))[1])
    rows = spark.createDataFrame([("/a.png", bytearray(b"\x89PNG"), "image/png")], "p string, extracted_image binary, image_mime_type string")
    found = jobs.score_images(
        rows, [("map", None)], lambda: lambda b: "cap", lambda: lambda url, names: names[0], lambda: lambda prompt, url: url
    ).first()
    assert found.image_summary == "data:image/png;base64,iVBORw==" and found.image_classification == "map"
    assert staged and not any("base64" in c or "url" in c for columns in staged for c in columns)


def test_assets_in_any_quoting(spark):
    html = """<a href="/a">x</a><IMG SRC='/b'><img src=/c><img src="data:image/PNG;base64,aGk="><img src='data:image/gif;base64,!'>"""
    row = spark.range(1).select(
        assets.linked_assets(F.lit(html)).alias("linked"), assets.inline_images(F.lit(html)).alias("inline")
    ).first()
    assert [a.asset for a in row.linked][:3] == ["/a", "/b", "/c"] and [a.ordinal for a in row.linked] == [1, 2, 3, 4, 5]
    assert [(bytes(i.extracted_image), i.image_mime_type, i.image_ext) for i in row.inline] == [(b"hi", "image/png", ".png")]
