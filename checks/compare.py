"""Run queries against their expected results: ``python -m checks.compare <folder> [query ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from lumbung.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for table in TABLES:
        db.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return db


def plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    """Columns by name, then rows as text in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)
    return [columns[i] for i in order], lines


def difference(spark, db, name: str, folder: str) -> str:
    """Empty when both sides agree in columns, value types and values."""
    frame = QUERIES[name](spark, folder)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(ORACLE[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if got == want:
        return ""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    only_spark, only_sql = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return (
        f"{len(got[1])} rows != {len(want[1])} rows" if len(got[1]) != len(want[1]) else "values differ"
    ) + f"; {len(only_spark)} only in Spark {sorted(only_spark)[:2]}; {len(only_sql)} only in SQL {sorted(only_sql)[:2]}"


def main(folder: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            found = difference(spark, db, name, folder) if name in ORACLE else "no expected result"
        except Exception as error:  # keep going: one report for all queries
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s {found[:900]}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
