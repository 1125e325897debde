"""The bucketed index against a plain dictionary, and what a sync opens, lists and cleans up."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from papertrove.operators.search import embed_text, similarity_search
from papertrove.streaming import buckets
from papertrove.streaming.buckets import open_buckets
from papertrove.streaming.sync import change_stream

SCHEMA = "id bigint, version bigint, content string, gone boolean, score double"


class Feed:
    """A folder of change files, an index over it, and what the index should hold."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.n, self.plain = spark, root, 0, {}
        self.index = open_buckets(f"{root}/index", "id", "version", **options)

    def add(self, *rows):
        self.n += 1
        self.spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA).coalesce(1).write.parquet(f"{self.root}/feed/{self.n}")
        for key, version, content, gone in rows:
            if key not in self.plain or version > self.plain[key][0]:
                self.plain[key] = version, content, bool(gone)

    def sync(self):
        source = change_stream(self.spark, f"{self.root}/feed/*", files_per_batch=1)
        self.index.sync(source, "content", deleted=F.col("gone"))

    def live(self):
        found = self.index.read(self.spark).collect()
        assert len({r.id for r in found}) == len(found)
        return {r.id: (r.version, r.content) for r in found}

    def expected(self):
        return {key: value[:2] for key, value in self.plain.items() if not value[2]}

    def manifest(self):
        return self.index.manifest(self.spark).collect()


def words(rng):
    return " ".join(rng.choices(["red", "blue", "dog", "cat", "hen", "fox", "ox", "the"], k=rng.randint(1, 6)))


@pytest.fixture(scope="module")
def synced(spark, tmp_path_factory):
    """A first load, then ten small batches with updates, late rows, removals and new keys."""
    feed = Feed(spark, tmp_path_factory.mktemp("buckets"), buckets=16, parts=4, most_commits=3)
    rng = random.Random(1)
    feed.add(*[(i, 10, words(rng), False) for i in range(300)], (None, 1, "no key", False))
    seen = []
    for n in range(6):
        picked = rng.sample(range(320), 3)
        feed.add(*[(i, rng.choice([5, 11 + n]), words(rng), rng.random() < 0.3) for i in picked])
        seen.append(picked)
    feed.sync()
    return feed


def test_rows_equal_a_dictionary(synced):
    assert synced.live() == synced.expected()


def test_search_equals_a_scan(spark, synced):
    rows = spark.createDataFrame([(k, c) for k, (_, c) in synced.expected().items() if k is not None], "id long, content string")
    index = embed_text(rows, "content").cache()
    for question in ("red dog", "the ox", "zebra"):
        found = synced.index.search(spark, question, ["id", "content"], 7).collect()
        full = similarity_search(index, question, ["id", "content"], 7).collect()
        assert [tuple(r) for r in found if r["id"] is not None] == [tuple(r) for r in full if r["score"] > 0]


def test_buckets_and_postings_are_compacted(synced):
    manifest = synced.manifest()
    changes = {(r["slot"], r["commit"]) for r in manifest if r["kind"] == buckets.CHANGE}
    per_bucket = {}
    for slot, _ in changes:
        per_bucket[slot] = per_bucket.get(slot, 0) + 1
    assert max(per_bucket.values(), default=0) <= 3
    assert len({r["commit"] for r in manifest if r["kind"] == buckets.POSTINGS}) <= 5


def test_a_sync_opens_the_buckets_of_its_keys(spark, synced):
    before = {r["file"] for r in synced.manifest() if r["kind"] in (buckets.BASE, buckets.CHANGE)}
    slots = {r["file"]: r["slot"] for r in synced.manifest()}
    synced.add((7, 50, "one key alone", False))
    synced.sync()
    after = synced.manifest()
    sync = next(r for r in after if r["kind"] == buckets.SYNC)
    own = spark.createDataFrame([(7,)], "id long").select(synced.index._bucket()).first()[0]
    assert sync["slot"] == 1 and sync["rows"] == sum(slots[f] == own for f in before)
    gone = before - {r["file"] for r in after}
    assert {slots[f] for f in gone} <= {own}
    assert synced.live() == synced.expected()


def test_listings_do_not_follow_the_commits(spark, tmp_path, monkeypatch):
    listed = []
    real = buckets.child_names
    monkeypatch.setattr(buckets, "child_names", lambda path: listed.append(path) or real(path))
    feed = Feed(spark, tmp_path, buckets=2, parts=2)
    counts = []
    for n in range(3):
        feed.add((n, 1, "red dog", False))
        feed.sync()
        listed.clear()
        feed.index.read(spark).count()
        feed.index.search(spark, "dog", ["id"]).count()
        counts.append(len(listed))
    assert counts[0] == counts[1] == counts[2]


def test_clean_up_leaves_the_live_files(spark, synced):
    live = {r["file"] for r in synced.manifest() if r["file"]}
    assert synced.index.clean_up(spark, keep=1) > 0
    assert synced.index.commits() == [max(synced.index.commits())]
    assert synced.live() == synced.expected()
    assert {f.replace("file:", "") for f in live} == {str(p) for p in synced.root.glob("index/data/**/*.parquet")}
    assert synced.index.clean_up(spark) == 0


def test_a_repeated_commit_leaves_the_same_index(spark, synced):
    index, folder = synced.index, f"{synced.root}/again"
    rows = spark.createDataFrame([(1, 99, "again", False, 0.5)], SCHEMA)
    about = {"key": ["id"], "version": ["version"], "text": "content", "dimensions": 4096, "buckets": 4, "parts": 2}
    other = open_buckets(folder, "id", "version", buckets=4, parts=2)
    apply = other._apply(lambda r: embed_text(r, "content"), F.col("gone"), about)
    for _ in range(2):
        apply(rows, 0)
        assert [(r.id, r.content) for r in other.read(spark).collect()] == [(1, "again")]
    assert other.commits() == [0] and index.exists(spark)


def test_another_layout_is_refused(spark, synced):
    other = open_buckets(f"{synced.root}/index", "id", "version", buckets=99)
    with pytest.raises(ValueError, match="layout"):
        other.sync(change_stream(spark, f"{synced.root}/feed/*"), "content")
    with pytest.raises(ValueError, match="no index"):
        open_buckets(f"{synced.root}/none", "id", "version").read(spark)
