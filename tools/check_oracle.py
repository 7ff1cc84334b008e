"""Compare every registered query with its SQL, value by value.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain_value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(tuple(plain_value(r[n]) for n in names) for r in df.collect())
    rel = con.sql(sql)
    order = {n: i for i, n in enumerate(rel.columns)}
    if sorted(order) != names:
        return f"columns {names} vs {sorted(order)}", df
    want = sorted(tuple(plain_value(r[order[n]]) for n in names) for r in rel.fetchall())
    if got == want:
        return None, df
    diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"rows {len(got)} vs {len(want)}: {diff}", df


def main():
    from rowsmith.queries import ORACLES, QUERIES
    from rowsmith.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args else "/root/testdata/sf0.01"
    spark = build_session("check", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, fn in QUERIES.items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem, df = compare(spark, con, sf_dir, fn, ORACLES[name])
            else:
                df = fn(spark, sf_dir)
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            problem, df = f"{type(e).__name__}: {str(e)[:600]}", None
        bad += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        types = "" if df is None else ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}  {problem or types[:150]}", flush=True)
    print("failures:", bad)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
