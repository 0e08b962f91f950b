"""Compare registered queries with their oracle SQL on DuckDB."""
from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as from '{path}'")
    return con


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    for prefix, name in (("decimal", "decimal"), ("timestamp", "timestamp"),
                         ("bigint", "long"), ("integer", "int"), ("hugeint", "hugeint"),
                         ("varchar", "string")):
        if t.startswith(prefix):
            return name
    return t


def norm(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark, sf_dir: str, con, fn, sql: str) -> str | None:
    """None if both agree, else what differs."""
    df = fn(spark, sf_dir)
    rel = con.sql(sql)
    mine = sorted((c, kind(t)) for c, t in df.dtypes)
    theirs = sorted((c, kind(t)) for c, t in zip(rel.columns, rel.types))
    if [c for c, _ in mine] != [c for c, _ in theirs]:
        return f"columns {mine} / {theirs}"
    if mine != theirs:
        return f"types {[x for x in zip(mine, theirs) if x[0] != x[1]]}"
    cols = [c for c, _ in mine]
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    pos = [rel.columns.index(c) for c in cols]
    b = sorted((tuple(norm(r[i]) for i in pos) for r in rel.fetchall()), key=repr)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3] if len(a) < 50000 else "?"
        only_b = [r for r in b if r not in set(a)][:3] if len(a) < 50000 else "?"
        return f"{len(a)} rows / {len(b)} rows; spark {only_a} oracle {only_b} cols {cols}"
    return None if a else "both empty"


def main(sf: str, *keys: str) -> None:
    from ordermill import catalog
    from ordermill.session import build_session
    spark = build_session(cores=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con = oracle(sf_dir)
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for key in keys or qs:
        t0 = time.time()
        try:
            if key in sqls:
                problem = compare(spark, sf_dir, con, qs[key], sqls[key])
            else:
                rows = qs[key](spark, sf_dir).collect()
                problem = None if rows else "no rows"
                print(f"  (no oracle) {key}: {rows[:3]}")
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - t0:.1f}s "
              f"{problem or ''}", flush=True)
    print(len(keys or qs), "queries,", bad, "bad")


if __name__ == "__main__":
    main(*sys.argv[1:])
