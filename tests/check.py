"""Run registered queries in Spark and their SQL in DuckDB, and compare. Also a command: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


CLOCK = {}


def cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(cell(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


def compare(spark_df, con, sql):
    """Returns (spark rows, check rows, differing rows, a few examples)."""
    got_names = spark_df.columns
    got = rows_of(got_names, [tuple(r) for r in spark_df.collect()])
    CLOCK["spark"] = time.time()
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = rows_of(want_names, result.fetchall())
    if sorted(got_names) != sorted(want_names):
        return len(got), len(want), -1, [sorted(got_names), sorted(want_names)]
    from collections import Counter

    extra, missing = Counter(map(repr, got)), Counter(map(repr, want))
    common = extra & missing
    a, b = list((extra - common).elements()), list((missing - common).elements())
    return len(got), len(want), max(len(a), len(b)), sorted(a)[:3] + ["--"] + sorted(b)[:3]


def main(argv):
    sf = argv[0] if argv else "0.01"
    names = argv[1:]
    from barloom.session import session

    spark = session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    queries, oracle = entry.queries(), entry.oracle_sql()
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                n, m, diff, examples = compare(df, con, oracle[name])
                state = "ok" if diff == 0 and n == m else "DIFF"
                if state != "ok":
                    bad += 1
                print(f"{state:5} {name:32} {n:>8} {m:>8} {diff:>7} {CLOCK['spark'] - t:6.1f}s {time.time() - CLOCK['spark']:6.1f}s", flush=True)
                if state != "ok":
                    for e in examples:
                        print("      ", str(e)[:400], flush=True)
            else:
                n = df.count()
                print(f"rows  {name:32} {n:>8} {'':>16} {time.time() - t:6.1f}s", flush=True)
        except Exception as e:
            bad += 1
            print(f"FAIL  {name:32} {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
