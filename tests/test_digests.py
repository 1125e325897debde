"""Differences by digests against differences of whole tables, and what is read for them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from papertrove.operators import digests
from papertrove.operators.tables import table_changes

SCHEMA = "id long, part string, value double, _bucket_id int, level string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def listed(rows):
    return sorted(map(str, rows.collect()))


def test_same_rows_from_unequal_buckets_alone(spark, tmp_path):
    old = [(i, None if i % 7 == 0 else f"p{i % 3}", i / 3) for i in range(600)]
    new = [r for r in old if r[0] != 5] + [(1000, "new", 1.0)]
    new[10] = (*new[10][:2], None)
    for name, rows in (("old", old), ("new", new), ("same", old[::-1])):
        digests.write_digested(frame(spark, rows).repartition(3), ["id", "part"], str(tmp_path / name))
    paths = [str(tmp_path / name) for name in ("old", "new", "same")]
    whole = table_changes(frame(spark, old), frame(spark, new), ["id", "part"])
    found = digests.digest_changes(spark, paths[0], paths[1])
    assert found.columns == whole.columns and listed(found) == listed(whole)
    changed = spark.createDataFrame([(5, "p2"), (1000, "new"), new[10][:2]], "id long, part string")
    own = {r[0] for r in changed.select(F.pmod(F.xxhash64("id", "part"), F.lit(256))).collect()}
    assert set(digests.unequal_buckets(spark, paths[0], paths[1])) == own
    read = digests.digested_rows(spark, paths[0], sorted(own)).count()
    assert 0 < read < 40  # of 600 rows
    assert digests.unequal_buckets(spark, paths[0], paths[2]) == []
    assert digests.digest_changes(spark, paths[0], paths[2]).collect() == []


def test_empty_snapshots_and_other_layouts(spark, tmp_path):
    for name, rows, key, levels in (("none", [], "id", 1), ("one", [(1, "a", 1.0)], "id", 1), ("high", [], "id", 2), ("other", [], "part", 1)):
        digests.write_digested(frame(spark, rows), key, str(tmp_path / name), levels)
    one, none = str(tmp_path / "one"), str(tmp_path / "none")
    assert [r["change_type"] for r in digests.digest_changes(spark, none, one).collect()] == ["insert"]
    assert [r["change_type"] for r in digests.digest_changes(spark, one, none).collect()] == ["delete"]
    assert digests.digest_changes(spark, none, none).collect() == []
    with pytest.raises(ValueError, match="heights"):
        digests.digest_changes(spark, none, str(tmp_path / "high"))
    with pytest.raises(ValueError, match="keys"):
        digests.digest_changes(spark, none, str(tmp_path / "other"))
