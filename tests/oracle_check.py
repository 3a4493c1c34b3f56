"""Run every registered query against its DuckDB oracle and compare rows.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Rows are compared as multisets after sorting columns by name; floats must
agree exactly (the queries are built to be exact), dates and timestamps
are compared in ISO form.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RAW = ("region nation customer supplier part orders lineitem events documents "
       "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols, srows = canon(df.columns, srows)
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dcols, drows = canon(dcols, res.fetchall())
    status = "ok"
    detail = ""
    if scols != dcols:
        status, detail = "schema", f"spark={scols} duck={dcols}"
    elif len(srows) != len(drows):
        status, detail = "rows", f"spark={len(srows)} duck={len(drows)}"
    elif srows != drows:
        diff = [(a, b) for a, b in zip(srows, drows) if a != b]
        status, detail = "values", f"{len(diff)} differ, e.g. {diff[:2]}"
    return dict(name=name, status=status, rows=len(srows), spark_s=round(t1 - t0, 2), detail=detail)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from emporium.session import build_session
    spark = build_session()
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, oracles.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = dict(name=name, status="error", detail=f"{type(e).__name__}: {str(e)[:300]}")
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{bad} failing of {len([n for n in qs if not names or n in names])}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
