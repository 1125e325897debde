from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.operators import scoring
from papertrove.sources.storage import stage


def picky_maker():
    """Made inside a function, so that it travels to the workers by value."""

    def picky():
        def score(text, n):
            if n % 3 == 0:
                raise RuntimeError(f"no score for {n}")
            return len(text) + n

        return score

    return picky


def test_errors_are_captured_beside_the_value(spark):
    rows = spark.createDataFrame([("x" * i, i) for i in range(10)], "t string, n int")
    scored = scoring.score_batches(rows, ["t", "n"], "s", T.IntegerType(), picky_maker())
    for row in stage(scored, "scored").collect():
        expected = (None, f"no score for {row.n}") if row.n % 3 == 0 else (2 * row.n, None)
        assert (row.s.value, row.s.error) == expected


def test_errors_stop_the_job_on_request(spark):
    rows = spark.createDataFrame([("a", 3)], "t string, n int")
    with pytest.raises(Exception, match="no score for 3"):
        scoring.score_batches(rows, ["t", "n"], "s", T.IntegerType(), picky_maker(), on_error="fail").collect()
    with pytest.raises(ValueError):
        scoring.score_batches(rows, ["t", "n"], "s", T.IntegerType(), picky_maker(), on_error="ignore")


def test_scorer_is_made_once_per_task(spark):
    def make():
        calls = [0]

        def score(_):
            calls[0] += 1
            return calls[0]

        return score

    rows = spark.range(50).coalesce(1)
    found = scoring.score_batches(rows, ["id"], "s", T.LongType(), make).collect()
    assert max(r.s.value for r in found) == 50


CLASSES = [("default", "D"), ("chart", None), ("map", ""), ("flow", "F"), ("flow", "second")]


@pytest.mark.parametrize("default,expected", [("D", "D"), ("", ""), (None, "")])
def test_prompt_fallback(spark, default, expected):
    classes = [("default", default), *CLASSES[1:]]
    rows = spark.createDataFrame([(c,) for c in ("chart", "map", "flow", "none", None, "default")], "c string")
    found = {r.c: r for r in scoring.build_prompt(rows, "c", classes).collect()}
    assert {c: r.prompt for c, r in found.items()} == {
        "chart": expected, "map": expected, "flow": "F", "none": expected, None: expected, "default": expected
    }
    start = "Summarize this image of a map using the provided tools."
    assert found["map"].summary_prompt == (f"{start} Instructions: {expected}" if expected else start)


def test_deck_prompt(spark):
    rows = spark.createDataFrame([("a",)] * 19 + [("b",)], "deck string")
    found = {r.deck: r.deck_prompt for r in scoring.deck_prompt(rows, "deck").collect()}
    assert found["b"] == "<|image_1|>\nSummarize the deck of slides."
    assert found["a"].count("\n") == 19 and "<|image_19|>\nSummarize" in found["a"]


def test_latest_version(spark):
    versions = spark.createDataFrame([("a", "2"), ("a", "10"), ("b", "0"), ("b", "x")], "name string, version string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "name string")
    found = {r.name: r.latest_version for r in scoring.latest_version(asked, versions, "name", "version").collect()}
    assert found == {"a": 10, "b": 1, "c": 1}


def test_nearest_centroid(spark):
    random = np.random.default_rng(1)
    points = random.normal(size=(60, 5)).astype(np.float32)
    labels = random.integers(0, 4, 60)
    rows = spark.createDataFrame(
        [(i, p.tolist(), int(label)) for i, (p, label) in enumerate(zip(points, labels))], "id int, v array<float>, label int"
    )
    centers = scoring.centroids(rows, "label", "v")
    found = scoring.nearest_centroid(rows.drop("label"), "v", centers, [1, 2, 3, 9]).collect()
    means = {k: points[labels == k].astype(float).mean(0) for k in (1, 2, 3)}
    for row in found:
        p = points[row.id].astype(float)
        scores = {k: float(p @ m / np.linalg.norm(p) / np.linalg.norm(m)) for k, m in means.items()}
        best = max(scores, key=scores.get)
        assert row.class_label == best and abs(row.class_score - scores[best]) < 1e-6


def test_message_parts(spark):
    rows = spark.createDataFrame([("hi", "data:x")], "t string, u string")
    parts = scoring.with_message(rows, F.col("t"), F.col("u")).first().message
    assert [tuple(p) for p in parts] == [("text", "hi", None), ("image_url", None, "data:x")]
