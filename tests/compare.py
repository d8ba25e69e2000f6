"""Run catalogued queries in Spark and their SQL in DuckDB, and compare.

    python tests/compare.py <scale folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (int, float)):
        # repr tells -0.0 from 0.0
        return (1, float(value), repr(value))
    return (2, str(value))


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    columns, rows = _sorted(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    result = connection.execute(sql)
    expected_columns, expected = _sorted([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    kinds = {d[0]: str(d[1]) for d in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in spark_df.dtypes:
        if _TYPES.get(kind) != kinds[name]:
            return f"{name} is {kind} in Spark and {kinds[name]} in SQL"
    if len(rows) != len(expected):
        return f"{len(rows)} rows instead of {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0][0]} instead of {wrong[0][1]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from emberline.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "8")
    connection = open_duckdb(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries), set(oracle) - set(queries)
    failed = 0
    for name in wanted or queries:
        started = time.time()
        try:
            if name in oracle:
                problem = differences(queries[name](spark, sf_dir), connection, oracle[name])
            else:
                rows = queries[name](spark, sf_dir).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - started:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
