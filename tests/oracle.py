"""Compare registered queries with their SQL on the same tables.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def difference(spark, db, sf_dir: str, query, statement: str) -> str | None:
    """None when equal, else a short description."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    cursor = db.execute(statement)
    described = [(c[0], str(c[1])) for c in cursor.description]
    want = canonical([c[0] for c in described], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {name: KINDS.get(kind, kind) for name, kind in described}
    off = {n: (k, kinds[n]) for n, k in df.dtypes if kinds[n] != k}
    if off:
        return f"types {off}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for mine, theirs in zip(got[1], want[1]):
        if mine != theirs:
            return f"first difference: {str(mine)[:300]} != {str(theirs)[:300]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from quern.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else DEFAULT_DIR
    spark = build_session(
        "oracle",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    statements, failed = oracle_sql(), 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            if name in statements:
                problem = difference(spark, db, sf_dir, query, statements[name])
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
