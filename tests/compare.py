"""Compare registered queries with their DuckDB statements: python tests/compare.py SF [KEY ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (float, decimal.Decimal)):
        return None if isinstance(value, float) and math.isnan(value) else round(float(value), 6)
    if isinstance(value, int):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when the frame and the statement agree, else what differs."""
    spark_rows = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_rows = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(spark_rows) != len(duck_rows):
        left = set(map(repr, spark_rows)) - set(map(repr, duck_rows))
        right = set(map(repr, duck_rows)) - set(map(repr, spark_rows))
        return f"rows {len(spark_rows)} != {len(duck_rows)}\n  spark {sorted(left)[:3]}\n  duck  {sorted(right)[:3]}"
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            n = sum(x != y for x, y in zip(spark_rows, duck_rows))
            return f"{n} rows differ\n  names {sorted(names)}\n  spark {a}\n  duck  {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from oncospan import session

    sf, keys = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                    spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = database(sf_dir)
    bad = 0
    for key in keys or queries:
        started = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key not in oracle:
                print(f"----  {key}: {df.count()} rows, no statement ({time.time() - started:.1f}s)", flush=True)
                continue
            result = difference(df, con, oracle[key])
            rows = df.count() if result is None and keys else ""
        except Exception as error:  # report and go on to the next query
            result, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'}  {key} {rows} ({time.time() - started:.1f}s) {result or ''}", flush=True)
    print(f"{bad} failed; without query: {sorted(set(oracle) - set(queries))}; without statement: {sorted(set(queries) - set(oracle))}")
