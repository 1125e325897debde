"""Keyed tables and their changes."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.operators.keys import assign_key, check_key, generate_key
from papertrove.operators.registry import KeyRegistry


def create_or_replace(
    df: DataFrame,
    name: str,
    key: str,
    root: str,
    order_by: Sequence[str] | None = None,
    registry: KeyRegistry | None = None,
) -> DataFrame:
    """Write ``df`` as the new content of table ``name`` with a generated key column in front.

    The rows go to a folder of their own and the key is audited there; only then is the name moved to that folder, so
    readers see the old table or the new one. When the columns change, the name has to be dropped and made again; only
    then is there a moment without it. The name must not be a table that owns its files, which dropping would delete.
    With ``order_by`` the key is the place in the order of a natural key, so equal rows get equal keys, but a row
    inserted in front moves those behind it. With a ``registry`` every natural key keeps the id it was given first.
    """
    if registry is not None and registry.key != key:
        raise ValueError(f"the registry names its ids {registry.key}, not {key}")
    if df.sparkSession.catalog.tableExists(name) and df.sparkSession.catalog.getTable(name).tableType == "MANAGED":
        raise ValueError(f"table {name} owns its files and would lose them")
    spark = df.sparkSession
    if registry is not None:
        keyed = registry.assign(df)
    else:
        keyed = assign_key(df, key, order_by) if order_by else generate_key(df, key)
    folder = f"{root.rstrip('/')}/{name}/version-{uuid.uuid4().hex}"
    keyed.write.parquet(folder)
    written = spark.read.parquet(folder)
    check_key(written, key)
    same = spark.catalog.tableExists(name) and [f.simpleString() for f in spark.table(name).schema] == [
        f.simpleString() for f in written.schema
    ]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=folder, source="parquet")
    return spark.table(name)


def append(df: DataFrame, name: str, key: str) -> DataFrame:
    """Add rows to a table; the key is generated behind the highest one in use and must not be in ``df``.

    The key of the whole table is audited afterwards, since another writer may have taken the same numbers.
    """
    spark = df.sparkSession
    target = spark.table(name)
    expected = [c for c in target.columns if c != key]
    if sorted(df.columns) != sorted(expected):
        raise ValueError(f"table {name} has columns {expected}, the rows have {df.columns}")
    types = {f.name: f.dataType.simpleString() for f in target.schema}
    wrong = [f.name for f in df.schema if f.dataType.simpleString() != types[f.name]]
    if wrong:
        raise ValueError(f"column types of {wrong} differ from table {name}")
    highest = target.agg(F.max(key).alias("highest")).first().highest
    generate_key(df.select(*expected), key, after=highest).select(*target.columns).write.insertInto(name)
    spark.catalog.refreshTable(name)
    check_key(spark.table(name), key)
    return spark.table(name)


def latest_rows(changes: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the highest version of every key, reduced before the shuffle so a hot key is no burden."""
    rest = [c for c in changes.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return changes.groupBy(*key).agg(newest).select(*key, "_row.*").select(*changes.columns)


def table_changes(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Row-level difference of two snapshots: ``change_type`` and the columns of the table.

    Types are ``insert``, ``delete``, ``update_preimage`` and ``update_postimage``; keys and values are compared
    null-safe.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in new.columns if c not in keys]
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the snapshots have different columns")

    def packed(df: DataFrame, name: str) -> DataFrame:
        named = [F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)]
        return df.select(*named, F.struct(F.lit(True).alias("_here"), *rest).alias(name))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(row).alias("row"))

    same = [F.col(f"_old_{i}").eqNullSafe(F.col(f"_new_{i}")) for i in range(len(keys))]
    both = packed(old, "_old").join(packed(new, "_new"), functools.reduce(Column.__and__, same), "full_outer")
    both = both.select("_old", "_new", *[F.coalesce(f"_old_{i}", f"_new_{i}").alias(k) for i, k in enumerate(keys)])
    changes = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(change("update_preimage", "_old"), change("update_postimage", "_new")),
        )
    )
    return both.select(*keys, F.explode(changes).alias("_change")).select(
        "_change.change_type", *[c if c in keys else F.col(f"_change.row.{c}").alias(c) for c in new.columns]
    )


def change_feed(
    old: DataFrame | None,
    new: DataFrame,
    key: str | Sequence[str],
    version: int,
    version_column: str = "version",
    removed_column: str = "removed",
) -> DataFrame:
    """The rows a synced index needs to follow a table from ``old`` to ``new``.

    New and changed rows as they are now, removed rows with ``removed`` set, all stamped with ``version``, which has to
    grow from one feed to the next; a table that has columns of these names needs others here. Without ``old`` every row of ``new`` is fed.
    """
    clash = {version_column, removed_column} & set(new.columns)
    if clash:
        raise ValueError(f"the table has columns {sorted(clash)}; give the feed's own columns other names")
    stamp = F.lit(version).cast("long").alias(version_column)
    if old is None:
        return new.select(stamp, F.lit(False).alias(removed_column), *new.columns)
    changes = table_changes(old, new, key).where(F.col("change_type") != "update_preimage")
    return changes.select(stamp, (F.col("change_type") == "delete").alias(removed_column), *new.columns)
