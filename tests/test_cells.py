"""Cells that follow a change table against a plain dictionary and an exact search."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from papertrove.operators.search import knn_exact
from papertrove.streaming import cells
from papertrove.streaming.cells import open_cells
from papertrove.streaming.sync import change_stream

SCHEMA = "a bigint, b string, version bigint, embedding array<double>, gone boolean, cell string, v string"
WIDTH = 6


class Feed:
    """A folder of change files, an index over it, and what the index should hold."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.n, self.plain = spark, root, 0, {}
        self.index = open_cells(f"{root}/index", ["a", "b"], "version", **options)

    def frame(self, rows):
        return self.spark.createDataFrame([(*key, version, vector, gone, "x", "y") for key, version, vector, gone in rows], SCHEMA)

    def add(self, *rows):
        self.n += 1
        self.frame(rows).coalesce(1).write.parquet(f"{self.root}/feed/{self.n}")
        for key, version, vector, gone in rows:
            if key not in self.plain or version > self.plain[key][0]:
                self.plain[key] = version, vector, bool(gone)

    def sync(self):
        self.index.sync(change_stream(self.spark, f"{self.root}/feed/*", files_per_batch=1), deleted=F.col("gone"))

    def expected(self):
        whole = {k: v for k, (_, v, gone) in self.plain.items() if not gone and v is not None}
        return {k: v for k, v in whole.items() if len(v) == WIDTH and all(x is not None and np.isfinite(x) for x in v)}

    def check(self, ask=True):
        rows = self.index.read(self.spark).collect()
        assert len({(r.a, r.b) for r in rows}) == len(rows)
        assert {(r.a, r.b): r.embedding for r in rows} == self.expected()
        if not ask:
            return
        table = self.spark.createDataFrame([(*k, v) for k, v in self.expected().items()], "a bigint, b string, embedding array<double>")
        asked = table.where("b = 'k0'")
        plain = knn_exact(asked, table, query_key=["a", "b"], vector_key=["a", "b"])
        exact = self.index.search(self.spark, asked, probes=10_000, query_key=["a", "b"])
        assert sorted(map(str, exact.collect())) == sorted(map(str, plain.collect()))
        near = self.index.search(self.spark, asked, query_key=["a", "b"])
        best = {(r.query_id, r.neighbor_id) for r in plain.collect()}
        assert len(best & {(r.query_id, r.neighbor_id) for r in near.collect()}) >= 0.9 * len(best)

    def manifest(self, kind=None):
        return [r for r in self.index.manifest(self.spark).collect() if kind in (None, r.kind)]


def vector(rng, spot):
    return [float(x) for x in np.array(spot) + [rng.gauss(0, 0.1) for _ in range(WIDTH)]]


def key(i):
    return (i, f"k{i % 9}") if i % 50 else (i, None)


def test_cells_follow_a_table(spark, tmp_path):
    rng = random.Random(3)
    spots = [[rng.gauss(0, 1) for _ in range(WIDTH)] for _ in range(30)]
    feed = Feed(spark, tmp_path, buckets=4, most_commits=2)
    feed.add(*[(key(i), 10, vector(rng, spots[i % 20]), False) for i in range(300)], (key(300), 10, None, False))
    feed.sync()
    before = len({r.slot for r in feed.manifest(cells.BASE)})
    # Few keys: few cells are written.
    feed.add((key(4), 11, vector(rng, spots[2]), False), (key(5), 11, None, True), (key(6), 9, [1.0] * WIDTH, False))
    feed.sync()
    (told,) = feed.manifest(cells.SYNC)
    assert told.slot <= 4
    feed.check(ask=False)
    # One spot grows to many times its share: its cell is split; keys come, go, move, come back and spoil.
    feed.add(*[(key(i), 12, vector(rng, spots[25]), False) for i in range(400, 800)])
    feed.sync()
    feed.check()
    assert len({r.slot for r in feed.manifest(cells.BASE)}) > before
    spoiled = [None, [1.0], [float("nan")] * WIDTH, [None] * WIDTH, [float("inf")] * WIDTH]
    for n in range(2):
        rows = [(key(i), 20 + n, vector(rng, rng.choice(spots)), i % 2 == n) for i in rng.sample(range(900), 60)]
        feed.add(*rows, *[(key(800 + i), 20 + n, spoil, False) for i, spoil in enumerate(spoiled)])
    feed.sync()
    feed.check(ask=False)
    assert feed.index.clean_up(spark, keep=1) > 0
    feed.check()
    # The whole table goes and a part of it comes back.
    feed.add(*[(k, 30, None, True) for k in list(feed.plain)])
    feed.sync()
    assert feed.index.read(spark).collect() == [] == list(feed.expected())
    feed.add(*[(key(i), 31, vector(rng, spots[i % 3]), False) for i in range(120)])
    feed.sync()
    feed.check(ask=False)


def test_a_commit_that_runs_again_and_copies(spark, tmp_path):
    rng = random.Random(4)
    feed = Feed(spark, tmp_path, buckets=2)
    spot = vector(rng, [1] * WIDTH)
    rows = [(key(i), 1, spot if i < 200 else vector(rng, [i % 5 - 2] * WIDTH), False) for i in range(300)]
    # Equal vectors cannot be split; the cell waits until it has doubled.
    for _ in range(2):
        feed.index._apply(F.col("gone"))(feed.frame(rows), 0)
    feed.plain = {k: (v, x, g) for k, v, x, g in rows}
    feed.check(ask=False)
    more = [(key(i), 2, vector(rng, [i % 5 - 2] * WIDTH), i % 2 == 0) for i in range(150, 350)]
    for _ in range(2):
        feed.index._apply(F.col("gone"))(feed.frame(more), 1)
    feed.plain |= {k: (v, x, g) for k, v, x, g in more}
    feed.check()


def test_nothing_synced(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    with pytest.raises(ValueError, match="no index"):
        feed.index.manifest(spark)
    feed.add((key(1), 1, None, False))
    feed.sync()
    assert feed.index.search(spark, feed.frame([(key(1), 1, [1.0] * WIDTH, False)]), query_key="a").collect() == []
    feed.add((key(1), 2, [1.0] * WIDTH, False), (key(2), 1, [0.0] * WIDTH, False))
    feed.sync()
    feed.check()
