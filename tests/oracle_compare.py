"""Compare a registered Spark query with its DuckDB SQL on the same parquet tables.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str):
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return {"query": name, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_rows = len(srows) == len(drows)
    ok_vals = ok_cols and rows_key(scols, srows) == rows_key(dcols, drows)
    out = {"query": name, "rows": len(srows), "oracle_rows": len(drows), "cols": ok_cols,
           "values": ok_vals, "spark_s": round(t1 - t0, 2)}
    if not ok_vals:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
        if ok_cols:
            a, b = rows_key(scols, srows), rows_key(dcols, drows)
            sa, sb = set(a), set(b)
            out["only_spark"] = [r for r in a if r not in sb][:3]
            out["only_oracle"] = [r for r in b if r not in sa][:3]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from __spark_entry__ import queries
    if os.environ.get("PLAIN_SESSION"):  # the driver's view: default settings, any time zone
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]")
                 .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from skilltrends.session import build_session
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    for n in names or list(queries()):
        try:
            print(compare(spark, con, n, sf_dir), flush=True)
        except Exception as e:  # report and go on
            print({"query": n, "error": repr(e)[:1500]}, flush=True)


if __name__ == "__main__":
    main()
