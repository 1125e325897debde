"""Even weights per task, and helper names that meet columns of the same name."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from papertrove.operators import documents, scoring, search, tables
from papertrove.sources.tables import spread_by_weight


def shares(frame, weight):
    found = frame.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(weight).alias("w"), F.count("*").alias("n")).collect()
    return {r["part"]: (r["w"], r["n"]) for r in found}


def test_one_heavy_file_leaves_even_shares(spark):
    rng = random.Random(1)
    rows = [(f"f{i}", rng.randint(1, 50), "x", 1.0) for i in range(2000)]
    rows.append(("heavy", sum(r[1] for r in rows), "x", 1.0))
    rows += [("null", None, "x", 1.0), ("none", 0, "x", 1.0), ("negative", -5, "x", 1.0)]
    df = spark.createDataFrame(rows, "path string, length long, w string, `a.b` double").repartition(7)
    even = spread_by_weight(df, 9, "length", "path")
    assert even.columns == df.columns and sorted(map(str, even.collect())) == sorted(map(str, df.collect()))
    found = shares(even.where("length IS NULL OR length >= 0"), "length")
    light = [w for part, (w, n) in found.items() if part != 0]
    assert found[0][1] == 1 and len(light) == 8
    assert max(light) - min(light) <= 100


def test_odd_weights(spark):
    schema = "path string, length long"
    assert spread_by_weight(spark.createDataFrame([], schema), 3, "length", "path").collect() == []
    for weights in ([0] * 50, [None] * 50, [7] * 3, [100, 1]):
        df = spark.createDataFrame([(str(i), w) for i, w in enumerate(weights)], schema)
        even = spread_by_weight(df, 3, "length", "path")
        assert sorted(map(str, even.collect())) == sorted(map(str, df.collect()))
        assert len(shares(even, "length")) == min(3, len(weights))


def test_helper_names_meet_no_columns(spark):
    classes = [("default", "d"), ("cat", "c")]
    rows = spark.createDataFrame([("cat", "x", "y"), ("dog", "x", "y")], "kind string, class_name string, _prompt string")
    found = scoring.prompt_fallback(rows, "kind", classes).collect()
    assert {(r["kind"], r["class_name"], r["_prompt"], r["prompt"]) for r in found} == {("cat", "x", "y", "c"), ("dog", "x", "y", "d")}
    named = spark.createDataFrame([("cat", "x")], "class_name string, prompt string")
    assert scoring.prompt_fallback(named, "class_name", classes).first()["prompt"] == "c"

    items = spark.createDataFrame([(1, 2)], "_item long, id long")
    out = documents.explode_structs(items, F.array(F.struct(F.lit(5).alias("a")))).first()
    assert tuple(out) == (1, 2, 5)

    points = spark.createDataFrame([([1.0, 0.0], 0, "keep", "keep", "keep")], "v array<double>, label long, _best string, _unit string, _centers string")
    near = scoring.nearest_centroid(points, "v", scoring.centroids(points, "label", "v"), [0]).first()
    assert (near["_best"], near["_unit"], near["_centers"], near["class_label"]) == ("keep", "keep", "keep", 0)

    index = search.embed_text(spark.createDataFrame([(1, "dog", 0.5, "x")], "id long, content string, score double, _asked string"), "content")
    assert tuple(search.similarity_search(index, "dog", ["content", "_asked"]).first()) == ("dog", "x", 1.0)
    with pytest.raises(ValueError, match="own column"):
        search.similarity_search(index, "dog", ["score"])

    old = spark.createDataFrame([(1, 7, True)], "id long, version long, removed boolean")
    new = spark.createDataFrame([(2, 8, False)], "id long, version long, removed boolean")
    with pytest.raises(ValueError, match="other names"):
        tables.change_feed(old, new, "id", 3)
    feed = tables.change_feed(old, new, "id", 3, "fed", "gone").collect()
    assert {(r["fed"], r["gone"], r["id"], r["version"], r["removed"]) for r in feed} == {(3, True, 1, 7, True), (3, False, 2, 8, False)}
