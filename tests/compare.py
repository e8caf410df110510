"""Runs suite queries and their SQL equivalents side by side: ``python tests/compare.py [sf] [name…]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def library_queries() -> set[str]:
    """The queries of the library's own operators, without those of the training-data subpackage."""
    from lakerill.plans import suite_changes, suite_quality, suite_sales, suite_sources, suite_streams

    suites = (suite_sales, suite_quality, suite_changes, suite_sources, suite_streams)
    return {name for suite in suites for name in suite.QUERIES}


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _rows(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, folder: str, query, sql: str) -> str | None:
    """None if both agree in column names, rows and values, else what differs."""
    df = query(spark, folder)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = _rows([c[0] for c in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} against {b}"
    return None


def main() -> None:
    from conftest import session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = session(), connect(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            if name in oracle:
                verdict = compare(spark, con, folder, query, oracle[name])
            else:
                verdict = None
                print(f"{name}: rows only, {len(query(spark, folder).collect())}")
        except Exception as e:  # the run goes on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - started:.2f}s {verdict or ''}", flush=True)
    print("all agree" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
