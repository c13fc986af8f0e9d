"""Run registered queries in Spark and their oracle SQL in DuckDB; compare as multisets.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        # exact: decimal sums are cast to double once, at the end, in both engines
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = [columns[i].lower() for i in order]
    return names, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, keys: list[str] | None = None) -> dict[str, dict]:
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        s_names, s_bag = rows_of(df.columns, srows)
        res = {"spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
        if key in sqls:
            cur = con.execute(sqls[key])
            cols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            d_names, d_bag = rows_of(cols, drows)
            res.update(
                oracle_rows=len(drows),
                names_match=s_names == d_names,
                values_match=s_bag == d_bag,
            )
            if not res["values_match"]:
                res["only_spark"] = list((s_bag - d_bag).items())[:3]
                res["only_oracle"] = list((d_bag - s_bag).items())[:3]
                if s_names != d_names:
                    res["names"] = (s_names, d_names)
        out[key] = res
    return out


if __name__ == "__main__":
    from aqualedger.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    results = compare(spark, sf, keys)
    bad = 0
    for k, r in results.items():
        ok = r.get("values_match", True) and r.get("names_match", True)
        bad += not ok
        print(("OK  " if ok else "FAIL"), k, {x: y for x, y in r.items() if x not in ("only_spark", "only_oracle", "names")})
        if not ok:
            print("   only_spark:", r.get("only_spark"))
            print("   only_oracle:", r.get("only_oracle"))
            print("   names:", r.get("names"))
    print(f"{len(results) - bad}/{len(results)} match")
