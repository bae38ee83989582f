"""Compare every registered Spark query with its DuckDB oracle on one scale factor.

Mirrors the driver's check: row count, column names, order-insensitive values.
Run: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(norm(r[c]) for c in sorted(cols)) for r in sdf.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t_spark, 2), note="rows-only")
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(dcols)}
    if sorted(dcols) != sorted(cols):
        return dict(name=name, ok=False, note=f"columns spark={sorted(cols)} duck={sorted(dcols)}")
    drows = [tuple(norm(r[idx[c]]) for c in sorted(cols)) for r in drows_raw]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    ok = sorted(srows, key=key) == sorted(drows, key=key)
    note = ""
    if not ok:
        s_only = set(srows) - set(drows)
        d_only = set(drows) - set(srows)
        note = f"spark={len(srows)} duck={len(drows)} s_only={list(s_only)[:2]} d_only={list(d_only)[:2]}"
    return dict(name=name, ok=ok, rows=len(srows), spark_s=round(t_spark, 2), note=note)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from sluice.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
