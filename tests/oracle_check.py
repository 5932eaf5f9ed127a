"""Compare each registered Spark query with its SQL oracle run by DuckDB.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]

Columns are matched by name; rows are compared as an order-insensitive
multiset of values (floats exactly, as the driver's value hash would).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def compare(spark, con, name, fn, sql, sf_dir, show=3):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_rows = sdf.collect()
    rel = con.execute(sql)
    d_cols = [x[0] for x in rel.description]
    d_types = {x[0]: str(x[1]) for x in rel.description}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} sql={sorted(d_cols)}")
        return False, problems
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} sql={len(d_rows)}")
    if sc != dc:
        only_s = list((sc - dc).elements())[:show]
        only_d = list((dc - sc).elements())[:show]
        problems.append(f"values differ ({sum((sc - dc).values())} spark-only rows) cols={order}\n"
                        f"   spark-only: {only_s}\n   sql-only:   {only_d}")
    types = {c: (s_types[c], d_types[c]) for c in order}
    return not problems, problems + [f"types {types}"] if problems else [f"{len(s_rows)} rows"]


def main(argv):
    sf = "/root/testdata/sf0.01"
    names = []
    it = iter(argv)
    for a in it:
        if a == "--sf":
            sf = next(it)
        else:
            names.append(a)
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from feedlake.session import local_session
    spark = local_session()
    con = duck(sf)
    qs, sq = queries(), oracle_sql()
    names = names or [n for n in qs if n in sq]
    bad = 0
    for n in names:
        if n not in sq:
            print(f"--  {n}: no oracle (rows-only)")
            continue
        try:
            ok, msgs = compare(spark, con, n, qs[n], sq[n], sf)
        except Exception as e:  # report and continue
            ok, msgs = False, [f"ERROR {type(e).__name__}: {str(e)[:600]}"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + n + ": " + " | ".join(msgs))
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
