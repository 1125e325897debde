"""Compressed vectors: codes and tables against plain sums, recall against the exact search, odd inputs."""

from __future__ import annotations

import numpy as np
import pytest

from papertrove.operators import quantized
from papertrove.operators.search import knn_exact


def frame(spark, points, first=0):
    rows = [(first + i, None if p is None else [float(x) for x in p], "clash", 0.5, 1) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string, score double, place int")


def as_rows(found):
    return {(r.query_id, r.neighbor_id): (r.score, r.rank) for r in found.collect()}


@pytest.mark.parametrize("dimensions, pieces", [(12, 4), (10, 4), (5, 5), (3, 8)])
def test_tables_add_up_to_products_with_the_decoded_vectors(dimensions, pieces):
    rng = np.random.default_rng(1)
    rows, queries = rng.normal(size=(50, dimensions)), rng.normal(size=(7, dimensions))
    width = -(-dimensions // pieces)
    centers = rng.normal(size=(pieces, 9, width))
    codes = quantized.encode_rows(rows, centers)
    for m, piece in enumerate(quantized.pieces_of(rows, pieces)):
        distances = ((piece[:, None] - centers[m][None]) ** 2).sum(axis=2)
        assert np.allclose(distances[np.arange(50), codes[:, m]], distances.min(axis=1))
    decoded = np.stack([centers[m][codes[:, m]] for m in range(pieces)])
    tables = np.einsum("mqw,mcw->qmc", quantized.pieces_of(queries, pieces), centers).astype(np.float32)
    plain = np.einsum("mqw,mvw->qv", quantized.pieces_of(queries, pieces), decoded)
    best = quantized._Kept(tables, 5)
    for start in range(0, 50, 8):
        best.add(codes[start : start + 8], start)
    assert np.allclose(np.sort(best.scores, axis=1), np.sort(plain, axis=1)[:, -5:], atol=1e-4)


def test_recall_and_exact_scores(spark, tmp_path):
    rng = np.random.default_rng(2)
    points = list(rng.normal(size=(1500, 24)))
    points[:500] = [points[0]] * 500  # a third of all rows are copies of one vector
    held = frame(spark, points).repartition(5)
    queries = frame(spark, points[490:700], 490)
    quantized.write_codes(held, str(tmp_path / "codes"), pieces=12)
    near = as_rows(quantized.knn_quantized(spark, str(tmp_path / "codes"), held, queries))
    exact = as_rows(knn_exact(queries, held))
    assert len(near) == len(exact) == 210 * 5
    # Copies tie, so what counts is whether a row is as good as the exact one of its rank.
    by_rank = {(q, rank): score for (q, _), (score, rank) in exact.items()}
    good = sum(score >= by_rank[q, rank] for (q, _), (score, rank) in near.items())
    assert good >= 0.95 * len(exact)
    assert all(score <= by_rank[q, rank] for (q, _), (score, rank) in near.items())


def test_odd_vectors_and_small_tables(spark, tmp_path):
    points = [[1, 0, 0], None, [0, 1, 0], [float("nan"), 0, 0], [0, 0], [0, 0, 0], [1, 1, 0]]
    held = frame(spark, points)
    quantized.write_codes(held, str(tmp_path / "a"), pieces=3, dimensions=3)
    near = as_rows(quantized.knn_quantized(spark, str(tmp_path / "a"), held, held, k=2))
    assert near == as_rows(knn_exact(held, held, 2, dimensions=3))
    empty = frame(spark, [])
    quantized.write_codes(empty, str(tmp_path / "b"), pieces=2, dimensions=3)
    assert quantized.knn_quantized(spark, str(tmp_path / "b"), empty, held).collect() == []
