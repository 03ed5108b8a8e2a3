"""Compare each registered Spark query with its DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Checks, per query: same column names, compatible column types, same row
count, and the same multiset of rows (order-insensitive; doubles rounded to
6 decimals, -0.0 folded into 0.0).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Exact type correspondence (an int column must not come back as BIGINT).
_SPARK_FAMILY = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
    "double": "float64", "float": "float32", "string": "str", "boolean": "bool",
    "timestamp_ntz": "ts", "timestamp": "ts_tz", "date": "date",
}
_DUCK_FAMILY = {
    "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
    "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "str", "BOOLEAN": "bool",
    "TIMESTAMP": "ts", "TIMESTAMP WITH TIME ZONE": "ts_tz", "DATE": "date",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(rows, order):
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name, fn, sql, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = sdf.collect()
    t_spark = time.time() - t0
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t_spark, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res["ok"] = False
        res["why"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return res
    s_order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    type_issues = []
    for si, di in zip(s_order, d_order):
        fs = _SPARK_FAMILY.get(s_types[si], s_types[si])
        fd = _DUCK_FAMILY.get(d_types[di], d_types[di])
        if fs != fd:
            type_issues.append(f"{s_cols[si]}: spark {s_types[si]} vs oracle {d_types[di]}")
    if type_issues:
        res["ok"] = False
        res["why"] = "types differ: " + "; ".join(type_issues)
        return res
    a, b = _rows(s_rows, s_order), _rows(d_rows, d_order)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res["ok"] = False
        res["why"] = f"values differ; spark-only e.g. {only_s}; oracle-only e.g. {only_d}"
        return res
    res["ok"] = True
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from wellmart.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if os.path.isdir(a):
            sf_dir = a
        else:
            names.append(a)
    spark = local_session(8)
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            rows = qs[name](spark, sf_dir).count()
            print(f"SKIP-ORACLE {name}: {rows} rows (no oracle SQL)")
            continue
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as e:  # report and continue with the next query
            r = {"query": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        status = "OK  " if r["ok"] else "FAIL"
        print(f"{status} {name}: rows spark={r.get('spark_rows')} oracle={r.get('oracle_rows')} "
              f"t={r.get('spark_sec')}s {r.get('why', '')}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
