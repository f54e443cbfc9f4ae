"""Side-by-side check of registered queries against their SQL: ``python -m agentlake.plans.check [name-prefix ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from agentlake.core import build_session
from agentlake.plans import load_all

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


#: Queries that may have no SQL; others without any fail. Their results are compared in tests.
ROWS_ONLY = {"v16_approximate_neighbours", "m6_plan_route_collect"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple((type(_plain(r[i])).__name__, repr(_plain(r[i]))) for i in order) for r in rows)
    )


def compare(spark, con, sf_dir, name, fn, sql):
    t = time.time()
    df = fn(spark, sf_dir)
    left = canon(df.columns, [tuple(r) for r in df.collect()])
    secs = time.time() - t
    if sql is None:
        return name in ROWS_ONLY, f"rows-only {len(left[1])} rows", secs
    t = time.time()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    right = canon(cols, cur.fetchall())
    duck = time.time() - t
    if left[0] != right[0]:
        return False, f"columns {left[0]} vs {right[0]}", secs
    if len(left[1]) != len(right[1]):
        return False, f"{len(left[1])} rows vs {len(right[1])}", secs
    if left[1] != right[1]:
        diffs = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
        return False, f"{len(diffs)} rows differ, first {diffs[0]}"[:1500], secs
    return True, f"{len(left[1])} rows (duck {duck:.1f}s)", secs


def main(argv):
    sf = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf, argv = argv[0], argv[1:]
    queries, oracle = load_all()
    spark = build_session(master="local[8]", partitions=8)
    con = connect(sf)
    bad = 0
    for name, fn in queries.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            ok, msg, secs = compare(spark, con, sf, name, fn, oracle.get(name))
        except Exception as e:  # report and go on with the next query
            ok, msg, secs = False, f"{type(e).__name__}: {str(e)[:1200]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {secs:.1f}s {msg}", flush=True)
    print("failures:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
