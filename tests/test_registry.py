"""Keys that stay, against a dictionary."""

from __future__ import annotations

import pytest

from papertrove.operators.registry import open_registry
from papertrove.operators.tables import create_or_replace

SCHEMA = "place string, n long, text string, _natural string, commit int"


def rows_of(spark, *keys):
    return spark.createDataFrame([(p, n, f"{p}-{n}", "clash", 1) for p, n in keys], SCHEMA).repartition(3)


def ids(frame):
    return {(r["place"], r["n"]): r["id"] for r in frame.collect()}


def test_inserted_rows_move_no_key(spark, tmp_path):
    registry = open_registry(str(tmp_path / "r"), ["place", "n"], buckets=4)
    first = ids(registry.assign(rows_of(spark, ("b", 1), ("c", 2), ("c", None))))
    assert first == {("b", 1): 1, ("c", None): 2, ("c", 2): 3}
    second = ids(registry.assign(rows_of(spark, ("a", 9), ("b", 1), ("c", 2), ("c", None), (None, 1))))
    assert {k: second[k] for k in first} == first
    assert {second["a", 9], second[None, 1]} == {4, 5}
    # Left out and brought back, in another order.
    assert ids(registry.assign(rows_of(spark, ("a", 9)))) == {("a", 9): second["a", 9]}
    third = ids(registry.assign(rows_of(spark, ("z", 1), ("b", 1))))
    assert third == {("b", 1): 1, ("z", 1): 6}
    assert ids(registry.known(spark)) == {**second, ("z", 1): 6}


def test_only_the_buckets_of_the_keys_are_read(spark, tmp_path):
    registry = open_registry(str(tmp_path / "r"), "n", buckets=16)
    frame = spark.createDataFrame([(i,) for i in range(200)], "n long")
    registry.register(frame)
    plan = registry.known(spark, [3])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "_bucket" in filters and "= 3" in filters


def test_repeats_empty_tables_and_clashes(spark, tmp_path):
    registry = open_registry(str(tmp_path / "r"), ["place", "n"], buckets=2)
    assert registry.known(spark) is None
    with pytest.raises(ValueError, match="repeats"):
        registry.assign(rows_of(spark, ("a", 1), ("a", 1)))
    assert registry.assign(rows_of(spark)).collect() == []
    assert ids(registry.assign(rows_of(spark, ("a", 1)))) == {("a", 1): 1}
    assert registry.assign(rows_of(spark)).collect() == []
    with pytest.raises(ValueError, match="already"):
        open_registry(str(tmp_path / "x"), "place", key="n").assign(rows_of(spark, ("a", 1)))


def test_a_table_keeps_its_keys(spark, tmp_path):
    registry = open_registry(str(tmp_path / "r"), ["place", "n"])
    for keys in ([("b", 1), ("c", 1)], [("a", 1), ("b", 1), ("c", 1)]):
        table = create_or_replace(rows_of(spark, *keys), "kept_keys", "id", str(tmp_path / "t"), registry=registry)
    assert ids(table) == {("b", 1): 1, ("c", 1): 2, ("a", 1): 3}
    with pytest.raises(ValueError, match="names its ids"):
        create_or_replace(rows_of(spark, ("a", 1)), "other", "key", str(tmp_path / "t"), registry=registry)
    spark.sql("DROP TABLE kept_keys")
