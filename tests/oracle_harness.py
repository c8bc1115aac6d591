"""Compare a registered Spark query with its DuckDB oracle.

Columns are sorted by name; rows are compared as a multiset of normalised
value tuples (order-insensitive), like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, int):
        return int(v)
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.select(*s_cols).collect()]
    rel = con.execute(sql)
    d_cols_raw = [d[0] for d in rel.description]
    d_rows_raw = rel.fetchall()
    order = sorted(range(len(d_cols_raw)), key=lambda i: d_cols_raw[i])
    d_cols = [d_cols_raw[i] for i in order]
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_rows_raw]
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols}
    sc, dc = Counter(s_rows), Counter(d_rows)
    out["values_match"] = out["columns_match"] and sc == dc
    if not out["values_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["only_spark"] = list((sc - dc).elements())[:3]
        out["only_oracle"] = list((dc - sc).elements())[:3]
    return out


if __name__ == "__main__":
    import time
    from tierflow.session import build_session
    import __spark_entry__ as E

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN_SESSION"):   # a session without tierflow's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("SESSION_TZ"):   # results must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    qs, sqls = E.queries(), E.oracle_sql()
    names = sys.argv[1:] or list(qs)
    con = duck(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, qs[n], sqls[n], sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "values_match": False, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += not r["values_match"]
        status = "OK " if r["values_match"] else "BAD"
        print(f"{status} {n:28s} {time.time() - t:6.2f}s "
              + ("" if r["values_match"] else str({k: v for k, v in r.items() if k != 'name'})),
              flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
