"""Run registered queries against their DuckDB twins and compare results.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        r = round(v, 4)
        return ("f", 0.0 if r == 0 else r)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def _kind(rows, i):
    for r in rows:
        if r[i] is not None:
            return _norm(r[i])[0]
    return None


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
        out["match"] = False
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    kinds = {}
    for c, a, b in zip(order, si, di):
        ka, kb = _kind(s_rows, a), _kind(d_rows, b)
        if ka and kb and ka != kb:
            kinds[c] = (ka, kb)
    out["type_mismatch"] = kinds
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
    out["values_match"] = s_norm == d_norm
    if not out["values_match"]:
        diff = [(a, b) for a, b in zip(s_norm, d_norm) if a != b][:3]
        out["first_diffs"] = diff
    out["match"] = out["values_match"] and not kinds and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from wattlake.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("oracle-compare")
    con = duck_connection(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    ok = 0
    rows_only = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        if name not in orc:
            n = df.count()
            rows_only += 1
            print(f"{name:28s} rows-only  rows={n} ({time.time() - t0:.1f}s)")
            continue
        try:
            r = compare(df, con, orc[name])
        except Exception as ex:  # report and continue
            bad += 1
            print(f"{name:28s} ERROR {type(ex).__name__}: {str(ex)[:300]}")
            continue
        tag = "OK " if r["match"] else "BAD"
        bad += 0 if r["match"] else 1
        ok += 1 if r["match"] else 0
        print(f"{name:28s} {tag} rows={r['spark_rows']}/{r['oracle_rows']} ({time.time() - t0:.1f}s)"
              + ("" if r["match"] else f" {r}"))
    print(f"SUMMARY ok={ok} bad={bad} rows_only={rows_only}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
