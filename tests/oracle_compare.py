"""Run registered queries on Spark and their oracle SQL on DuckDB and compare
row count, column names and an order-insensitive value hash.

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir, sql):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from rental_mart.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        scols = df.columns
        srows = [tuple(r) for r in df.collect()]
        st = time.time() - t0
        if k not in orc:
            print(f"{k:34s} rows={len(srows):7d} (no oracle) {st:.1f}s")
            continue
        dcols, drows = duck(sf_dir, orc[k])
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        bad += not ok
        print(f"{k:34s} rows={len(srows):7d}/{len(drows):7d} cols={'ok' if sorted(scols)==sorted(dcols) else (scols, dcols)} "
              f"hash={'ok' if sh==dh else 'MISMATCH'} {st:.1f}s")
        if not ok and sh != dh:
            ds, dd = set(sl) - set(dl), set(dl) - set(sl)
            print("   spark-only:", list(ds)[:3])
            print("   duck-only: ", list(dd)[:3])
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
