"""Compare registered queries with their DuckDB SQL: ``python tests/compare.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CHECKED = "/root/testdata/sf0.01"
FOLDER = os.environ.get("COMPARE_SF_DIR", CHECKED)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN"}


def difference(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and the SQL result, or none."""
    ours = normal(frame.columns, frame.collect())
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} and {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{str(a)[:300]} and {str(b)[:300]}"
    kinds = {name: KINDS.get(kind, kind) for name, kind in frame.dtypes}
    wrong = {n: (kinds[n], types[n]) for n in kinds if kinds[n] != types[n]}
    return f"types {wrong}" if wrong else None


def main(names: list[str]) -> int:
    import __spark_entry__ as contract
    from papertrove.session import get_session

    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(FOLDER)
    oracles, bad = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, FOLDER)
            found = difference(frame, con, oracles[name].replace(CHECKED, FOLDER)) if name in oracles else f"rows only: {frame.count()}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found) and not found.startswith("rows only")
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
