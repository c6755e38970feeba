"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = _table(names, res.fetchall())
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    spark = session()
    sf, only = sys.argv[1], sys.argv[2:]
    con, sqls = connect(sf), entry.oracle_sql()
    for name, q in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = q(spark, sf)
            if name in sqls:
                res = compare(df, con, sqls[name]) or f"ok {df.count()} rows"
            else:
                res = f"no SQL, {df.count()} rows"
        except Exception as e:
            res = "ERROR " + str(e)[:1500]
        print(f"{name:28s} {time.time() - t:6.2f}s  {res}", flush=True)
