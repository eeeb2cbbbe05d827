"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the sorted multiset of rows (doubles
to 1e-9 relative).  Prints one line per query and a summary.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    import tempfile

    con = duckdb.connect()
    con.execute(f"SET temp_directory='{tempfile.mkdtemp(prefix='duck-', dir='/tmp')}'")
    con.execute("SET max_temp_directory_size='4GB'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", v)
    if hasattr(v, "asDict"):
        return ("r", str(v))
    if isinstance(v, (list, tuple)):
        return ("l", str(list(v)))
    return ("v", v)


def _key(row):
    return tuple((type(x).__name__ if x is not None else "", str(x)) for x in row)


def same_rows(a, b) -> tuple[bool, str]:
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    sa = sorted(a, key=_key)
    sb = sorted(b, key=_key)
    for ra, rb in zip(sa, sb):
        for x, y in zip(ra, rb):
            if isinstance(x, float) or isinstance(y, float):
                if x is None or y is None:
                    if x is not y:
                        return False, f"{ra} vs {rb}"
                    continue
                if not math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9):
                    return False, f"{ra} vs {rb}"
            elif x != y and str(x) != str(y):
                return False, f"{ra} vs {rb}"
    return True, ""


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from basketry.session import build_session

    spark = build_session(8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok_all = True
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            ok_all = False
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        t1 = time.time()
        res = con.execute(sql[name])
        dcols = [d[0] for d in res.description]
        drows = [tuple(r) for r in res.fetchall()]
        td = time.time() - t1
        if sorted(cols) != sorted(dcols):
            print(f"FAIL {name}: columns {cols} vs {dcols}")
            ok_all = False
            continue
        order = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in order) for r in drows]
        ok, why = same_rows(rows, drows)
        ok_all &= ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {len(rows)} rows spark {ts:.1f}s duckdb {td:.1f}s {why[:300]}")
    spark.stop()
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
