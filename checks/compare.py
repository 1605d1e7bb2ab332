"""Runs queries next to their SQL and says where they differ.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False, name=None))


def cell(v) -> str:
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}" if not v.is_integer() else str(int(v))
    return str(v)


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    for c in mine.columns:
        a, b = mine[c].dtype.kind, theirs[c].dtype.kind
        if a != b and len(mine) and "O" in (a, b) and mine[c].notna().all() and theirs[c].notna().all():
            return f"type of {c}: {mine[c].dtype} != {theirs[c].dtype}"
    a, b = rows(mine), rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main(sf: str, names: list[str]) -> int:
    from checks import QUERIES, SQL
    from placeweave.session import local_session

    spark, con, failed = local_session("8"), connect(sf), []
    for name in names or QUERIES:
        start = time.time()
        try:
            mine = QUERIES[name](spark, sf).toPandas()
            took = time.time() - start
            if name not in SQL:
                print(f"rows  {name} {len(mine)} rows {took:.1f}s", flush=True)
                continue
            start = time.time()
            bad = difference(mine, con.execute(SQL[name]).fetchdf())
            sql_took = time.time() - start
        except Exception as e:  # a report of all queries must outlive one of them
            bad, took, sql_took, mine = f"{type(e).__name__}: {str(e)[:1500]}", 0, 0, []
        print(f"{'FAIL ' if bad else 'ok   '} {name} {len(mine)} rows {took:.1f}s sql {sql_took:.1f}s {bad or ''}", flush=True)
        if bad:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
