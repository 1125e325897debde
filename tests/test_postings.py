"""Stored postings: a scan for every few dimensions, weights by place, and vectors as plain counting makes them."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from papertrove.functions import vectors
from papertrove.operators import search


def test_no_scan_has_more_conditions_than_can_be_compiled(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} a{chr(97 + i % 26)}") for i in range(200)], "id int, t string")
    search.write_postings(rows, "t", ["id"], str(tmp_path), parts=3)
    stored = spark.read.parquet(f"{tmp_path}/postings")
    asked = {r.dim: 0.5 for r in stored.select("dim").distinct().collect()}
    assert len(asked) > 2 * search.SCAN_DIMENSIONS
    found = search.open_dimensions(stored, {dim: F.col("dim") == dim for dim in asked}, 3)
    assert found.count() == stored.count()
    filters = re.findall(r"Filter .*", found._jdf.queryExecution().executedPlan().toString())
    assert len(filters) == -(-len(asked) // search.SCAN_DIMENSIONS)
    assert all(0 < f.count("dim#") <= search.SCAN_DIMENSIONS for f in filters)
    assert search.open_dimensions(stored, {}, 3).count() == 0
    hits = {r.id: r.score for r in search.posting_hits(stored, list(asked.items()), 3, ["id"]).collect()}
    want = {r.id: round(r.s / 2, 6) for r in stored.groupBy(F.col("key_0").alias("id")).agg(F.sum("weight").alias("s")).collect()}
    assert hits == want


def test_weights_by_place(spark):
    weights = {3: 0.1 + 0.2, 7: 1e-17}
    dims = spark.range(12).select(F.col("id").cast("int").alias("dim"))
    found = {r.dim: r.w for r in dims.select("dim", search.weight_of(F.col("dim"), weights).alias("w")).collect()}
    assert found == {d: weights.get(d, 0.0) for d in range(12)}
    assert dims.select(search.weight_of(F.col("dim"), {}).alias("w")).distinct().collect()[0].w == 0.0


def test_vectors_of_a_batch(spark, monkeypatch):
    texts = ["b a b", None, "", "É 12", "İstanbul K kelvin", " ".join(f"{a}{b}" for a in "abcdef" for b in "ghijkl") * 2]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    for row in rows.select("id", F.lower("t").alias("t"), vectors.hash_embed(F.col("t"), 50).alias("v")).collect():
        words = re.findall("[a-z]+", row.t or "")
        counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 50 for w in words)
        norm = sum(n * n for n in counts.values()) ** 0.5
        assert [(e.dim, e.weight) for e in row.v] == [(d, counts[d] / norm) for d in sorted(counts)]
    monkeypatch.setattr(vectors, "KNOWN_TOKENS", 2)
    known = vectors._TokenDimensions(50)
    assert [known[w] for w in "abcab"] == [int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 50 for w in "abcab"]
    assert len(known) <= 2
