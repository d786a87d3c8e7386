"""Compare every query with its SQL in DuckDB: names, number of rows and exact values.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries
from quaylake.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kinds(rows: list[tuple]) -> list[str]:
    """Kind of the first non-null value of each column."""
    found = []
    for values in zip(*rows):
        kind = next((type(v).__name__ for v in values if v is not None), "")
        scale = next((str(v.as_tuple().exponent) for v in values if isinstance(v, Decimal)), "")
        found.append(kind + scale)
    return found


def difference(spark, con, folder: str, name: str, sizes: dict | None = None) -> str | None:
    df = queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sizes is not None:
        sizes[name] = (len(got), len(df.columns))
    sql = oracle_sql().get(name)
    if sql is None:
        return None
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    left, right = canonical(df.columns, got), canonical(columns, want)
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    if left != right:
        first = next((a, b) for a, b in zip(left, right) if a != b)
        return f"first difference: {first}"
    if kinds(left) != kinds(right):
        return f"types {kinds(left)} != {kinds(right)}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con = local_session(), database(folder)
    failed, sizes = 0, {}
    for name in wanted:
        start = time.time()
        try:
            problem = difference(spark, con, folder, name, sizes)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{time.time() - start:7.2f}s {name} {sizes.get(name, '')} {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
