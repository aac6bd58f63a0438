"""Run a named query in Spark and its oracle SQL in DuckDB; compare like the driver does.

Columns are sorted by name, rows compared order-insensitively; doubles are
compared after rounding to 6 places.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v  # exact: both engines must produce identical doubles
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> bool:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t = time.time()
    df = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols, srows = rows_of(df.columns, srows)
    ts = time.time() - t
    sql = E.oracle_sql().get(name)
    if sql is None:
        print(f"{name}: spark {len(srows)} rows ({ts:.1f}s), no oracle")
        return True
    res = con.execute(sql)
    dcols0 = [d[0] for d in res.description]
    dcols, drows = rows_of(dcols0, res.fetchall())
    ok = scols == dcols and srows == drows
    print(f"{name}: {'OK' if ok else 'MISMATCH'} spark {len(srows)} rows ({ts:.1f}s) duck {len(drows)} rows")
    if not ok and verbose:
        if scols != dcols:
            print("  spark cols", scols)
            print("  duck  cols", dcols)
        else:
            a, b = set(srows), set(drows)
            for r in sorted(a - b, key=str)[:8]:
                print("  spark only", r)
            for r in sorted(b - a, key=str)[:8]:
                print("  duck  only", r)
    return ok


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from tallyho.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    import __spark_entry__ as E

    con = duck(sf)
    bad = []
    for n in names or list(E.queries()):
        try:
            if not compare(spark, n, sf, con):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("FAILED:", bad)
