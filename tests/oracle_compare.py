"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row counts, column names and values (order-insensitive).

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as _dt
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


def _norm(v):
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name, sf_dir, con=None, queries=None, sqls=None):
    import __spark_entry__ as E

    queries = queries or E.queries()
    sqls = sqls or E.oracle_sql()
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_cols = df.columns
    if name not in sqls:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": t1 - t0}
    rel = con.sql(sqls[name])
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    type_diffs = [
        (c, t, d_types.get(c)) for c, t in df.dtypes if SPARK_TO_DUCK.get(t, t) != d_types.get(c)
    ]
    ok = sorted(s_cols) == sorted(d_cols) and a == b and not type_diffs
    out = {
        "name": name,
        "ok": ok,
        "rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
    }
    if not ok:
        out["cols"] = (s_cols, d_cols)
        out["type_diffs"] = type_diffs
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_oracle"] = list(sb - sa)[:3]
    return out


def main():
    from logsift.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or sorted(qs):
        try:
            r = compare(spark, n, sf_dir, con, qs, sqls)
        except Exception as ex:  # report and go on
            r = {"name": n, "ok": False, "error": repr(ex)[:800]}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
