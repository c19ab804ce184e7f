"""Runs registered queries and their oracle side by side.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    df = entry.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - t0
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(mine)} rows, no oracle, {spent:.1f}s"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}"
    if mine != theirs:
        diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return False, f"rows {len(mine)} vs {len(theirs)}; first differences {diff}"
    return True, f"{len(mine)} rows, {spent:.1f}s"


if __name__ == "__main__":
    from apptflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for n in names:
        try:
            ok, note = compare(spark, con, sf, n)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", n, note, flush=True)
    missing = set(entry.queries()) ^ set(entry.oracle_sql())
    print(f"{len(names) - bad}/{len(names)} equal; without a pair: {sorted(missing)}")
    sys.exit(bool(bad))
