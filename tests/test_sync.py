from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from papertrove.functions import vectors
from papertrove.operators import search
from papertrove.operators.search import similarity_search
from papertrove.plans import jobs
from papertrove.streaming.sync import SyncedIndex, change_stream, open_index

SCHEMA = "id bigint, version bigint, content string, gone boolean"


class Feed:
    """A folder of change files and an index over it."""

    def __init__(self, spark, root, files_per_batch=1, **options):
        self.spark, self.root, self.files_per_batch, self.n = spark, root, files_per_batch, 0
        self.index = open_index(f"{root}/index", "id", "version", **options)

    def add(self, *rows):
        self.n += 1
        path = f"{self.root}/feed/{self.n}"
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.parquet(path)

    def sync(self, **options):
        source = change_stream(self.spark, f"{self.root}/feed/*", files_per_batch=self.files_per_batch)
        self.index.sync(source, "content", deleted=F.col("gone"), **options)

    def live(self):
        return {r.id: (r.version, r.content) for r in self.index.read(self.spark).collect()}

    def batches(self, kind):
        folder = self.root / "index" / "generation=000000" / kind
        return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_sync_inserts_updates_deletes_and_ignores_late_rows(feed):
    assert not feed.index.exists()
    feed.add((1, 1, "one", False), (2, 1, "two", False), (3, 5, "three", False), (2, 2, "two new", None))
    feed.sync()
    assert feed.live() == {1: (1, "one"), 2: (2, "two new"), 3: (5, "three")}

    feed.add((3, 4, "late", False), (1, 3, "one new", False), (4, 1, "four", False))
    feed.add((2, 3, None, True), (1, 2, "late", False))
    feed.sync()
    assert feed.live() == {1: (3, "one new"), 3: (5, "three"), 4: (1, "four")}

    feed.add((2, 2, "late after delete", False), (5, 1, None, True))
    feed.sync()
    assert feed.live() == {1: (3, "one new"), 3: (5, "three"), 4: (1, "four")}

    feed.add((2, 9, "back", False))
    feed.sync()
    assert feed.live()[2] == (9, "back")


def test_a_sync_without_news_writes_nothing(feed):
    feed.add((1, 1, "one", False))
    feed.sync()
    before = feed.batches("changes"), feed.batches("base")
    feed.sync()
    assert (feed.batches("changes"), feed.batches("base")) == before


def test_small_changes_stay_beside_the_base(spark, tmp_path):
    feed = Feed(spark, tmp_path, compact_share=0.5)
    feed.add(*[(i, 1, f"row {i}", False) for i in range(20)])
    feed.sync()
    for i in range(3):
        feed.add((i, 2, f"new {i}", False), (i + 10, 2, None, True))
        feed.sync()
    assert len(feed.batches("changes")) == 3 and feed.batches("base") == ["batch=0"]
    live = feed.live()
    assert sorted(live) == [*range(10), *range(13, 20)] and live[2] == (2, "new 2")
    feed.add(*[(i, 3, "third", False) for i in range(9)])
    feed.sync()
    assert len(feed.batches("base")) == 2
    assert sorted(feed.live()) == [*range(10), *range(13, 20)] and feed.live()[8] == (3, "third")


def test_a_new_base_moves_no_vectors(feed, spark, monkeypatch):
    read, write = [], SyncedIndex._write

    def watched(index, rows, folder, kind, batch_id):
        scans = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
        read.extend((kind, "vector" in line.split("ReadSchema")[1]) for line in scans)
        write(index, rows, folder, kind, batch_id)

    monkeypatch.setattr(SyncedIndex, "_write", watched)
    feed.add(*[(i, 1, f"row {i}", False) for i in range(4)])
    feed.sync()
    feed.add((1, 2, "newer", False), (2, 2, None, True), (9, 1, None, False))
    feed.sync()
    assert len(feed.batches("base")) == 2 and feed.live() == {0: (1, "row 0"), 1: (2, "newer"), 3: (1, "row 3"), 9: (1, None)}
    assert ("base", False) in read and ("base", True) not in read
    stored = {r.id: r.vector for r in feed.index.read(spark).collect()}
    expected = feed.index.read(spark).withColumn("vector", vectors.hash_embed(F.col("content"))).collect()
    assert stored == {r.id: r.vector for r in expected}


def test_a_batch_that_is_run_again_changes_nothing(feed):
    feed.add((1, 1, "one", False), (2, 1, "two", False))
    feed.sync()
    feed.add((1, 2, "newer", False))
    feed.sync()
    want = feed.live()
    # Without its commit mark the stream runs the last batch again.
    commits = feed.root / "index" / "generation=000000" / "checkpoint" / "commits"
    for mark in (commits / "1", commits / ".1.crc"):
        mark.unlink(missing_ok=True)
    feed.sync()
    assert feed.live() == want


def test_full_refresh_makes_a_new_generation(feed):
    feed.add((1, 1, "one", False))
    feed.sync()
    shutil.rmtree(feed.root / "feed" / "1")
    feed.add((2, 1, "two", False))
    feed.sync(full_refresh=True)
    assert feed.live() == {2: (1, "two")}
    assert sorted(p.name for p in (feed.root / "index").iterdir()) == ["generation=000000", "generation=000001"]
    feed.add((3, 1, "three", False))
    feed.sync()
    assert sorted(feed.live()) == [2, 3]


def test_search_over_a_synced_index(feed, spark):
    feed.add((1, 1, "a dog on a couch", False), (2, 1, "a cat on a mat", False), (3, 1, "a dog", True))
    feed.sync()
    best = similarity_search(feed.index.read(spark), "picture of a dog on a couch", ["id", "content"], k=1).first()
    assert (best.id, best.content) == (1, "a dog on a couch")


def test_reading_a_missing_index(feed, spark):
    with pytest.raises(ValueError):
        feed.index.read(spark)


def test_one_index_is_synced_and_searched(spark, tmp_path):
    index = open_index(f"{tmp_path}/index", ["doc", "part"], "version", parts=96)
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"]
    texts = {(i, "p"): " ".join(words[i * 4 : i * 4 + 8]) for i in range(100)}
    frame = lambda rows: spark.createDataFrame([(*key, text) for key, text in rows.items()], "doc int, part string, content string")
    state = frame(texts)
    jobs.follow_table(None, state, index, f"{tmp_path}/feed", version=1)
    ask = lambda question, k=3: [(r.doc, r.part) for r in index.search(spark, question, ["doc", "part", "content"], k).collect()]
    assert ask(words[40])[:2] == [(9, "p"), (10, "p")]
    for version, name in ((2, "newb"), (3, "newc"), (4, "newd")):
        texts.pop((9, "p"), None)
        texts |= {(10, "p"): f"{name} row", (11, "p"): " ".join([words[40]] * version)}
        later = frame(texts)
        jobs.follow_table(state, later, index, f"{tmp_path}/feed", version=version)
        state = later
        assert ask(words[40]) == [(11, "p")] and ask(name) == [(10, "p")]
    assert ask("newb") == [] and ask("") == []
    questions = spark.createDataFrame([("a", words[40]), ("b", "newd")], "question_id string, text string")
    best = {r.query_id: tuple(r.neighbor_id) for r in index.search_many(questions, 1).collect()}
    assert best == {"a": (11, "p"), "b": (10, "p")}
    with pytest.raises(ValueError, match="full_refresh"):
        index.sync(change_stream(spark, f"{tmp_path}/feed"), "content", dimensions=64)

    # A question of 30 words opens a small share of the files.
    folder = f"{tmp_path}/index/generation=000000/postings/base/batch=0"
    about = index.about(spark)
    entries = search.question_entries(spark, " ".join(words[:30]), about.dimensions)
    every = spark.read.parquet(folder)
    opened = every.where(F.col("part").isin([dim % about.parts for dim, _ in entries]))
    count = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert len(entries) >= 29 and count(opened) < 0.35 * count(every)
