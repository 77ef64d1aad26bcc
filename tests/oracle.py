"""Compare registered Spark queries with their DuckDB oracle SQL.

Row count, column names and an order-insensitive multiset of normalised
values must all match. Usable from pytest and as a script::

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
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
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, out


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = rel.fetchall()
    return [cols[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        res["status"] = "no-oracle"
        return res
    d_cols, d_rows = rows_of_duck(con, sql)
    res["oracle_rows"] = len(d_rows)
    if s_cols != d_cols:
        res["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return res
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd:
        res["status"] = "ok"
    else:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        res["status"] = f"values differ: spark-only={only_s} oracle-only={only_d}"
    return res


def main(argv):
    from starweave.session import build_session
    from __spark_entry__ import queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
