"""Compare every registered query with its SQL statement.

Run as a script for a table of results: ``python tests/oracle_check.py [folder] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    ours, theirs = _rows(df.columns, got), _rows(expected_columns, expected)
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{left} != {right}"
    return None


def main() -> int:
    from snapledger.session import build_session
    import __spark_entry__ as entry
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("oracle-check", "local[8]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = connect(folder), 0
    for name in args[1:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, connection, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name}"
              + (f"\n      {problem}" if problem else ""), flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
