from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from papertrove.operators import keys, tables


def name():
    return f"t_{uuid.uuid4().hex}"


def test_assign_key_is_the_row_number(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("hot")).repartition(7)
    found = keys.assign_key(rows, "key", ["hot", "n"], partitions=6).collect()
    assert sorted((r.key, r.n) for r in found) == [(n + 1, n) for n in range(5000)]


def test_assign_key_of_nothing(spark):
    assert keys.assign_key(spark.range(0), "key", ["id"]).count() == 0


def test_generated_keys_start_behind(spark):
    found = [r.key for r in keys.generate_key(spark.range(100).repartition(4), "key", after=41).collect()]
    assert len(set(found)) == 100 and min(found) == 42


def test_key_audit(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    found = keys.key_violations(rows, ["a", "b"]).first()
    assert tuple(found) == (5, 2, 1, 2)
    assert tuple(keys.key_violations(rows.limit(0), "a").first()) == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        keys.check_key(rows, "a")


def test_create_replace_append(spark, tmp_path):
    table, root = name(), str(tmp_path)
    first = spark.createDataFrame([("b", 2), ("a", 1)], "source_path string, n int")
    made = tables.create_or_replace(first, table, "id", root, order_by=["source_path"])
    assert made.columns == ["id", "source_path", "n"]
    assert [tuple(r) for r in made.orderBy("id").collect()] == [(1, "a", 1), (2, "b", 2)]

    again = tables.create_or_replace(first.limit(1), table, "id", root)
    assert [(r.source_path, r.n) for r in again.collect()] == [("b", 2)]

    grown = tables.append(spark.createDataFrame([(3, "c")], "n int, source_path string"), table, "id")
    assert sorted((r.source_path, r.n) for r in grown.collect()) == [("b", 2), ("c", 3)]
    keys.check_key(grown, "id")

    with pytest.raises(ValueError, match="columns"):
        tables.append(spark.createDataFrame([("c",)], "source_path string"), table, "id")
    with pytest.raises(ValueError, match="types"):
        tables.append(spark.createDataFrame([("c", 1.5)], "source_path string, n double"), table, "id")

    other = tables.create_or_replace(first.select("source_path"), table, "id", root)
    assert other.columns == ["id", "source_path"] and other.count() == 2


def test_table_changes(spark):
    schema = "k int, a string, b array<int>"
    old = spark.createDataFrame([(1, "x", [1]), (2, None, [2]), (3, "z", None), (4, "same", [4])], schema)
    new = spark.createDataFrame([(2, "y", [2]), (3, "z", [3]), (4, "same", [4]), (5, "n", None)], schema)
    found = {(r.change_type, r.k, r.a, tuple(r.b or ())) for r in tables.table_changes(old, new, "k").collect()}
    assert found == {
        ("delete", 1, "x", (1,)),
        ("update_preimage", 2, None, (2,)), ("update_postimage", 2, "y", (2,)),
        ("update_preimage", 3, "z", ()), ("update_postimage", 3, "z", (3,)),
        ("insert", 5, "n", ()),
    }
    assert tables.table_changes(old, old, "k").count() == 0


def test_latest_rows(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, None)], "k int, v int, t string")
    assert sorted(tuple(r) for r in tables.latest_rows(rows, ["k"], ["v"]).collect()) == [(1, 3, "b"), (2, 1, None)]


def test_null_keys_are_compared(spark):
    rows = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    assert tables.table_changes(rows, rows, "k").count() == 0
    changed = spark.createDataFrame([(None, 5), (2, 2)], "k int, v int")
    found = {(r.change_type, r.k, r.v) for r in tables.table_changes(rows, changed, "k").collect()}
    assert found == {("update_preimage", None, 1), ("update_postimage", None, 5)}


def test_tables_that_own_their_files_are_refused(spark, tmp_path):
    spark.sql("CREATE TABLE owned (v INT) USING parquet")
    try:
        with pytest.raises(ValueError, match="owns its files"):
            tables.create_or_replace(spark.range(3).selectExpr("int(id) AS v"), "owned", "id", str(tmp_path))
        assert spark.catalog.tableExists("owned")
    finally:
        spark.sql("DROP TABLE owned")
