"""Ranked retrieval against a full scan, and what it leaves unread."""

from __future__ import annotations

import random

import pytest

from papertrove.operators import ranked, search

DIMENSIONS = 512


def rows_of(spark, texts):
    rows = [(i // 3, str(i % 3), t, "clash", 1, 2.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "a long, b string, text string, key_0 string, band int, score double")


def texts_of(seed, count):
    rng = random.Random(seed)
    rare = [f"{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"]
    out = ["the " * rng.randint(0, 4) + "of " * rng.randint(0, 3) + " ".join(rng.choices(rare, k=rng.randint(0, 25))) for _ in range(count)]
    return [*out, None, "", "...", out[0], out[0], "the", "THE the"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    texts = texts_of(1, 900)
    path = str(tmp_path_factory.mktemp("ranked") / "index")
    rows = rows_of(spark, texts)
    ranked.write_ranked(rows, "text", ["a", "b"], path, parts=4, buckets=4, dimensions=DIMENSIONS)
    index = search.embed_text(rows.drop("score"), "text", "vector", DIMENSIONS).cache()
    return path, index, texts


@pytest.mark.parametrize("question, k", [("the", 5), ("the of the of cm", 40), ("dn dn eo fp gq hr is jt ak bl cm", 1)])
def test_same_rows_as_a_full_scan(spark, stored, question, k):
    path, index, _ = stored
    found = ranked.search_ranked(spark, path, question, k).collect()
    full = search.similarity_search(index, question, ["a", "b"], k, ["a", "b"], dimensions=DIMENSIONS).collect()
    assert [(r["a"], r["b"], r["score"]) for r in found] == [tuple(r) for r in full if r["score"] > 0]


def test_a_whole_text_is_found_with_few_blocks(spark, stored):
    path, _, texts = stored
    found = ranked.search_ranked(spark, path, texts[0], 3).collect()
    assert [r["score"] for r in found] == [1.0, 1.0, 1.0]
    assert 0 < found[0]["blocks_opened"] < 0.5 * found[0]["blocks"]


@pytest.mark.parametrize("question", ["", "123", "zzzz yyyy"])
def test_questions_without_answer(spark, stored, question):
    entries = search.question_entries(spark, question, DIMENSIONS)
    found = ranked.search_ranked(spark, stored[0], question).collect()
    full = search.similarity_search(stored[1], question, ["a"], 5, ["a", "b"], dimensions=DIMENSIONS).collect()
    assert [r["score"] for r in found] == [r["score"] for r in full if r["score"] > 0]
    assert entries or not found


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    ranked.write_ranked(rows_of(spark, [None, ""]), "text", ["a"], path, parts=2, buckets=2)
    assert ranked.search_ranked(spark, path, "the").collect() == []


def test_opening_stops_below_the_bound():
    lists = [ranked._List(i, 0.5, [(b, 0.9 ** (b + i), 10 * (b + 1)) for b in range(20)]) for i in range(3)]
    left = ranked.open_until(lists, 0.6)
    assert left < 0.6 and left == pytest.approx(sum(each.bound() for each in lists))
    assert all(each.opened < 20 for each in lists)
    assert ranked.open_until(lists, -1) == 0.0
    assert all(each.opened == 20 for each in lists)
