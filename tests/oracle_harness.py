"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return cols, Counter(tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sp = fn(spark, sf_dir)
    spdf = pd.DataFrame(sp.collect(), columns=sp.columns)
    t1 = time.time()
    ddf = con.execute(sql).fetchdf()
    t2 = time.time()
    c1, r1 = rows_of(spdf)
    c2, r2 = rows_of(ddf)
    ok = c1 == c2 and r1 == r2
    info = dict(name=name, ok=ok, spark_rows=len(spdf), oracle_rows=len(ddf),
                spark_s=round(t1 - t0, 2), oracle_s=round(t2 - t1, 2))
    if not ok:
        info["cols"] = (c1, c2) if c1 != c2 else None
        info["only_spark"] = list((r1 - r2).items())[:3]
        info["only_oracle"] = list((r2 - r1).items())[:3]
    return info


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from shopfold.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print({"name": name, "rows_only": df.count()}, flush=True)
            continue
        info = compare(spark, con, name, fn, sqls[name], sf_dir)
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
