"""Compare registered queries with their SQL on DuckDB.

``python tests/oracle_check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type to DuckDB type.
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(rows, order) -> list[str]:
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if ours != theirs:
        return f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    names = sorted(ours)
    left = _rows([tuple(r) for r in df.collect()], [df.columns.index(n) for n in names])
    right = _rows(relation.fetchall(), [relation.columns.index(n) for n in names])
    if len(left) != len(right):
        return f"rows: {len(left)} against {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"values: {a[:500]}\n    against {b[:500]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(queries())
    spark = build_session(
        master="local[8]",
        shuffle_partitions=8,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else f"(rows only: {df.count()})"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("(")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
