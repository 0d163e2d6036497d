"""Run registered queries against their SQL twins: ``python tests/oracle_check.py [sf] [prefix...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _sorted(rows):
    return sorted((tuple(_cell(v) for v in r) for r in rows), key=repr)


def compare(con, df, sql: str) -> tuple[str, int]:
    """("ok" or a description of the first difference, number of rows)."""
    names = sorted(df.columns)
    spark_rows = _sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect())
    cur = con.execute(sql)
    got = [d[0] for d in cur.description]
    if sorted(got) != names:
        return f"columns {names} <> {sorted(got)}", len(spark_rows)
    order = [got.index(c) for c in names]
    sql_rows = _sorted(tuple(r[i] for i in order) for r in cur.fetchall())
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} <> {len(sql_rows)}", len(spark_rows)
    bad = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first {dict(zip(names, bad[0][0]))} <> {dict(zip(names, bad[0][1]))}", len(spark_rows)
    return "ok", len(spark_rows)


def main(argv: list[str]) -> int:
    from panelcast.plans import catalog
    from panelcast.session import local_session

    sf = argv[0] if argv else "sf0.001"
    prefixes = tuple(argv[1:])
    sf_dir = f"/root/testdata/{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name, fn in catalog.QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in catalog.ORACLES:
                verdict, n = compare(con, df, catalog.ORACLES[name])
            else:
                n = len(df.collect())
                verdict = "rows" if n else "EMPTY"
        except Exception as e:  # report and go on with the next query
            verdict, n = f"ERROR {type(e).__name__}: {str(e)[:600]}", -1
        if verdict not in ("ok", "rows"):
            failed.append(name)
        print(f"{name:34s} {n:7d} rows {time.time() - t0:6.2f} s  {verdict}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
