from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from papertrove.functions import vectors
from papertrove.operators import search


def brute_force(queries, held, k):
    """(query id, neighbour id, score, rank), from all pairs."""
    out = set()
    for qid, q in queries:
        scored = []
        for vid, v in held:
            norm = np.linalg.norm(q) * np.linalg.norm(v)
            scored.append((round(float(np.dot(q, v) / norm) if norm else 0.0, 6) + 0.0, vid))
        for rank, (score, vid) in enumerate(sorted(scored, key=lambda s: (-s[0], s[1]))[:k], 1):
            out.add((qid, vid, score, rank))
    return out


def as_set(frame):
    return {(r.query_id, r.neighbor_id, round(r.score, 6) + 0.0, r.rank) for r in frame.collect()}


@pytest.fixture(scope="module")
def crowd():
    """400 vectors, a third of them copies of one, some near it, one of zeros, few distinct scores."""
    random = np.random.default_rng(3)
    points = random.integers(-2, 3, size=(400, 6)).astype(float)
    points[random.permutation(400)[:133]] = [1, 2, 0, -1, 1, 2]
    points[17] = 0
    return [(int(i) * 3 + 1, p) for i, p in enumerate(points)]


@pytest.fixture(scope="module")
def crowd_frame(spark, crowd):
    return spark.createDataFrame([(i, p.tolist()) for i, p in crowd], "vec_id bigint, embedding array<double>").repartition(5)


@pytest.fixture(scope="module")
def expected(crowd):
    return brute_force(crowd, crowd, 4)


def test_exact(crowd_frame, expected):
    assert as_set(search.knn_exact(crowd_frame, crowd_frame, 4)) == expected


@pytest.mark.parametrize("query_block,vector_block", [(50, 30), (1000, 7), (7, 1000)])
def test_blocked(crowd_frame, expected, query_block, vector_block):
    found = search.knn_blocked(crowd_frame, crowd_frame, query_block, vector_block, k=4)
    assert as_set(found) == expected


def test_every_partition_is_scanned_where_it_lies(spark, crowd_frame, expected):
    found = search.knn_exact(crowd_frame, crowd_frame.repartition(37), 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert as_set(found) == expected


@pytest.mark.parametrize("blocks", [(1000, 1000), (16, 11)])
def test_cells_with_completion_are_exact(crowd_frame, expected, blocks):
    found = search.knn_cells(
        crowd_frame, crowd_frame, 4, cells=5, probes=1, exact=True, query_block=blocks[0], vector_block=blocks[1]
    )
    assert as_set(found) == expected


def test_cells_alone_return_k_rows(spark, crowd_frame):
    found = search.knn_cells(crowd_frame, crowd_frame, 4, cells=5, probes=1)
    assert {r["count"] for r in found.groupBy("query_id").count().collect()} == {4}


def test_stored_cells_answer_many_searches(spark, tmp_path, crowd, crowd_frame):
    search.write_cells(crowd_frame, str(tmp_path), cells=6)
    stored = spark.read.parquet(f"{tmp_path}/vectors")
    assert stored.count() == len(crowd)
    for low, k in ((0, 4), (600, 2), (900, 200)):
        asked = crowd_frame.where(F.col("vec_id") >= low)
        found = search.search_cells(asked, str(tmp_path), k, probes=1, exact=True)
        assert as_set(found) == brute_force([c for c in crowd if c[0] >= low], crowd, k)


def test_bounds_skip_cells_of_clustered_vectors(spark, tmp_path, monkeypatch):
    random = np.random.default_rng(5)
    middle = random.normal(size=(24, 8))
    points = np.concatenate([m + 0.01 * random.normal(size=(20, 8)) for m in middle])
    rows = [(i, p) for i, p in enumerate(points)]
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in rows], "vec_id bigint, embedding array<double>")
    search.write_cells(frame, str(tmp_path), cells=24)
    visits = []
    scan = search._Search.scan
    monkeypatch.setattr(
        search._Search, "scan", lambda self, asked, held, by=None: (visits.append(asked.count()), scan(self, asked, held, by))[1]
    )
    found = search.search_cells(frame, str(tmp_path), 5, probes=1, exact=True)
    assert as_set(found) == brute_force(rows, rows, 5)
    cells = spark.read.parquet(f"{tmp_path}/cells").count()
    assert sum(visits) < 0.5 * len(rows) * cells


def test_unsearchable_vectors_harm_no_other(spark):
    good = [(1, [1.0, 0.0, 0.0]), (2, [0.9, 0.1, 0.0]), (3, [0.0, 1.0, 0.0]), (8, [0.0, 0.0, 0.0])]
    bad = [(4, None), (5, [float("nan"), 1.0, 0.0]), (6, [1.0, None, 0.0]), (7, [1.0, 0.0]), (9, [float("inf"), 0.0, 1.0])]
    bad += [(10, [1.0, 2.0, 3.0, 4.0])]
    frame = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>").repartition(3)
    want = brute_force([(i, np.array(v)) for i, v in good], [(i, np.array(v)) for i, v in good], 2)
    assert as_set(search.knn_exact(frame, frame, 2)) == want
    assert as_set(search.knn_cells(frame, frame, 2, cells=2, exact=True)) == want
    lost = {r.vec_id: r.reason for r in search.unsearchable(frame, "vec_id", "embedding").collect()}
    reasons = ["no vector", "not finite", "null element", "other length", "not finite", "other length"]
    assert lost == dict(zip([i for i, _ in bad], reasons))
    empty = frame.where("false")
    assert search.knn_exact(empty, frame, 2).count() == search.knn_exact(frame, empty, 2).count() == 0
    assert search.knn_cells(frame, empty, 2).count() == 0


def test_text_and_composite_keys(spark, crowd, crowd_frame):
    doc, part = (F.col("vec_id") / 7).cast("int"), (F.col("vec_id") % 7).cast("string")
    named = crowd_frame.select(doc.alias("doc"), part.alias("part"), "embedding", F.concat(F.lit("k"), "vec_id").alias("name"))
    held = [((i // 7, str(i % 7)), v) for i, v in crowd]
    asked = [(f"k{i}", v) for i, v in crowd]
    options = {"query_key": "name", "vector_key": ["doc", "part"]}
    for found in (search.knn_exact(named, named, 3, **options), search.knn_cells(named, named, 3, cells=4, exact=True, **options)):
        rows = {(r.query_id, tuple(r.neighbor_id), round(r.score, 6) + 0.0, r.rank) for r in found.collect()}
        assert rows == brute_force(asked, held, 3)


def test_fewer_vectors_than_k(spark, crowd, crowd_frame):
    few = crowd_frame.where("vec_id <= 7")
    want = brute_force(crowd, [c for c in crowd if c[0] <= 7], 5)
    assert as_set(search.knn_exact(crowd_frame, few)) == want
    assert as_set(search.knn_cells(crowd_frame, few, cells=2, exact=True)) == want


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_of_cells(spark, scale):
    rows = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    exact = {(r.query_id, r.neighbor_id) for r in search.knn_exact(rows, rows).collect()}
    near = {(r.query_id, r.neighbor_id) for r in search.knn_cells(rows, rows).collect()}
    assert len(near & exact) / len(exact) >= 0.95


TEXTS = ["The cat sat on the mat.", "the the the THE", "A dog, a dog; a DOG!", "", "12 34 !?", None, "cat dog the", "Über ünder"]


def plain_vector(text, dimensions):
    import hashlib
    import re
    from collections import Counter

    words = [w for w in re.split("[^a-z]+", (text or "").lower()) if w]
    counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % dimensions for w in words)
    norm = sum(n * n for n in counts.values()) ** 0.5
    return {d: n / norm for d, n in counts.items()}


@pytest.mark.parametrize("dimensions", [4096, 3])
def test_hash_embed(spark, dimensions):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    for row in search.embed_text(rows, "t", dimensions=dimensions).collect():
        want = plain_vector(row.t, dimensions)
        assert [e.dim for e in row.vector] == sorted(want)
        assert {e.dim: pytest.approx(e.weight) for e in row.vector} == want


def test_vector_entries(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    found = {(r.id, r.dim): r.weight for r in search.vector_entries(rows, "t", ["id"]).collect()}
    want = {(i, d): w for i, t in enumerate(TEXTS) for d, w in plain_vector(t, 4096).items()}
    assert found == {k: pytest.approx(w) for k, w in want.items()}


def text_scores(question, dimensions=4096):
    q = plain_vector(question, dimensions)
    return {
        i: round(sum(w * q.get(d, 0.0) for d, w in plain_vector(t, dimensions).items()), 6) for i, t in enumerate(TEXTS)
    }


def test_similarity_search(spark):
    index = search.embed_text(spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string"), "content")
    found = search.similarity_search(index, "the dog", ["content", "id"], k=6).collect()
    assert found[0].__fields__ == ["content", "id", "score"]
    want = sorted(text_scores("the dog").items(), key=lambda s: (-s[1], s[0]))[:6]
    assert [(r.id, r.score) for r in found] == want
    rows = search.result_rows(search.similarity_search(index, "the dog", ["content", "id"], k=1), ["content", "id"])
    assert rows.select(search.field_at(F.col("row"), 1)).first()[0] == str(want[0][0])


@pytest.mark.parametrize("question", ["the dog", "nothing like it", ""])
def test_search_postings(spark, tmp_path, question):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string")
    path = f"{tmp_path}/postings"
    search.write_postings(rows, "content", ["id"], path, parts=3)
    found = search.search_postings(spark, path, question, k=3)
    want = sorted((s for s in text_scores(question).items() if s[1] > 0), key=lambda s: (-s[1], s[0]))[:3]
    assert [(r.id, r.score) for r in found.collect()] == want


def test_postings_prune_the_scan(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string")
    search.write_postings(rows, "content", ["id"], f"{tmp_path}/p", parts=5)
    words = " ".join(f"{a}{b}" for a in "abcdef" for b in "ghijkl")
    found = search.search_postings(spark, f"{tmp_path}/p", words)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("\n")[0]
    assert pushed.startswith("Or(") and "In(dim" not in pushed


@pytest.mark.parametrize("block", [None, 2])
def test_search_many(spark, block):
    index = search.embed_text(spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string"), "content")
    asked = ["the dog", "cat", "nothing like it", "mat on"]
    questions = search.embed_text(spark.createDataFrame(list(enumerate(asked)), "q int, t string"), "t")
    found = search.search_many(index, questions, k=3, question_key="q", query_block=block, vector_block=3)
    want = set()
    for qid, question in enumerate(asked):
        best = sorted(text_scores(question).items(), key=lambda s: (-s[1], s[0]))[:3]
        want |= {(qid, i, s, rank) for rank, (i, s) in enumerate(best, 1)}
    assert as_set(found) == want


def test_dense_and_unit(spark):
    row = spark.range(1).select(
        vectors.dense(vectors.hash_embed(F.lit("a b b"), 8), 8).alias("d"),
        vectors.unit(F.array(F.lit(3), F.lit(4))).alias("u"),
        vectors.unit(F.array(F.lit(0), F.lit(0))).alias("z"),
    ).first()
    want = plain_vector("a b b", 8)
    assert row.d == [pytest.approx(want.get(i, 0.0)) for i in range(8)]
    assert row.u == [0.6, 0.8] and row.z == [0.0, 0.0]
