"""What a scan passes on: the best of all rows that a task holds, and one row per query for all cells it looks into."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from papertrove.operators import quantized, search
from papertrove.streaming.cells import open_cells


def frame(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")


def plain(queries, held, k):
    """Places by score and place, as (place, score) per query."""
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (queries, held)]
    scores = np.round(unit[0] @ unit[1].T, 6) + 0.0
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(scores, order, axis=1)


def test_small_blocks_pass_on_k_rows_per_query_and_task(spark):
    points = np.random.default_rng(1).normal(size=(60, 5))
    rows = frame(spark, points).coalesce(1)
    scan = search._Search(3, search._unit_rows, 40, 16, 7)
    found = scan.scan(search._named(rows, "vec_id", "embedding", "q", 5), search._named(rows, "vec_id", "embedding", "n", 5))
    assert found.count() == 60 * 3


def test_best_keeps_ties_near_ties_and_copies():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    close = base[rng.integers(0, 40, 3000)] + rng.choice([0, 1e-9, 3e-7], size=(3000, 1)) * rng.normal(size=(3000, 16))
    held = np.concatenate([np.repeat(base[:1], 500, axis=0), close])
    want = plain(base, held, 5)
    unit = held / np.linalg.norm(held, axis=1, keepdims=True)
    kept = search._among_first(unit, 5, np.zeros(len(unit), np.int64))
    assert (kept < 500).sum() == 5
    best = search._Best(base / np.linalg.norm(base, axis=1, keepdims=True), 5, slice_rows=9)
    for at in rng.permutation(np.arange(0, len(kept), 100)):
        some = kept[at : at + 100]
        best.add(unit[some], unit[some].astype(np.float32), some)
    assert (best.scores == want[1]).all() and (best.places == want[0]).all()


def test_a_query_is_stored_once_for_all_its_cells(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(120, 6))
    rows = frame(spark, points)
    asked, scan = [], search._Search.scan
    monkeypatch.setattr(search._Search, "scan", lambda self, a, held, by=None: (asked.append(a.count()), scan(self, a, held, by))[1])
    exact = {tuple(r) for r in search.knn_exact(rows, rows, 3).collect()}
    asked.clear()
    assert {tuple(r) for r in search.knn_cells(rows, rows, 3, cells=20, probes=20).collect()} == exact
    assert asked == [120]
    index = open_cells(str(tmp_path / "live"), "vec_id", "version")
    index._apply(F.lit(False))(rows.withColumn("version", F.lit(1)), 0)
    asked.clear()
    assert {tuple(r) for r in index.search(spark, rows, 3, probes=1 << 30).collect()} == exact
    assert asked == [120]


@pytest.mark.parametrize("dimensions, pieces", [(12, 4), (10, 4)])
def test_decoded_products_are_the_sums_of_tables(dimensions, pieces):
    rng = np.random.default_rng(4)
    rows, queries = rng.normal(size=(50, dimensions)), rng.normal(size=(7, dimensions))
    centers = rng.normal(size=(pieces, 9, -(-dimensions // pieces)))
    codes = quantized.encode_rows(rows, centers)
    cut = quantized.pieces_of(queries, pieces)
    tables = quantized._Kept(np.einsum("mqw,mcw->qmc", cut, centers).astype(np.float32), 50)
    tables.add(codes, 0)
    products = cut.transpose(1, 0, 2).reshape(7, -1) @ quantized.decode_rows(codes, centers).T
    by_place = np.empty((7, 50))
    np.put_along_axis(by_place, tables.places, tables.scores, axis=1)
    assert np.allclose(by_place, products, atol=1e-4)


def test_quantised_searches_of_few_queries_and_many_copies(spark, tmp_path):
    rng = np.random.default_rng(5)
    points = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 300, axis=0), rng.normal(size=(300, 8))])
    held = frame(spark, points).repartition(3)
    quantized.write_codes(held, str(tmp_path), pieces=8)
    for asked in (held, held.where("vec_id in (2, 450)")):
        near = quantized.knn_quantized(spark, str(tmp_path), held, asked)
        assert near.count() == 5 * asked.count()
        exact = {(r.query_id, r.rank): r.score for r in search.knn_exact(asked, held).collect()}
        rows = near.collect()
        assert sum(r.score >= exact[r.query_id, r.rank] for r in rows) >= 0.95 * len(rows)
        # No row is passed on twice, and no window cuts a wider list.
        assert len({(r.query_id, r.neighbor_id) for r in rows}) == len(rows)
