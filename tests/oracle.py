"""Compare registered queries with their SQL answers in DuckDB: columns, row counts and values.

    python -m tests.oracle [--sf sf0.01] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return v
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if isinstance(v, str) else str(v)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(con, df, sql):
    got_cols = df.columns
    got = bag(got_cols, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols = [d[0] for d in res.description]
    want = bag(want_cols, res.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}", sum(got.values())
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list(extra)[:3]}, missing {list(missing)[:3]}",
            sum(got.values()),
        )
    return None, sum(got.values())


def main(args):
    import __spark_entry__ as entry

    from .session import local_session

    sf = "sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    sf_dir = f"/root/testdata/{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem, n = compare(con, df, oracles[name])
            else:
                problem, n = None, df.count()
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        rest = "" if name in oracles else " (no sql)"
        print(f"{mark} {name}{rest} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
