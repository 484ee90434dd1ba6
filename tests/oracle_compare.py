"""Run registered Spark queries next to their DuckDB twins and compare results.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``. Also used by the tests.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
    except Exception:
        pass
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(ts, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t, 2)
    res["duck_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    st = dict(sdf.dtypes)
    dt = {d[0]: str(d[1]) for d in cur.description}
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "smallint": "SMALLINT", "float": "FLOAT"}
    bad_types = {c: (st[c], dt.get(c)) for c in st if kinds.get(st[c], st[c]) != dt.get(c, "").upper()}
    if bad_types:
        res["types"] = bad_types
    if sc != dc:
        res["status"] = f"columns differ: spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        res["status"] = "row count differs"
    elif sr != dr:
        bad = next(i for i in range(len(sr)) if sr[i] != dr[i])
        res["status"] = f"values differ at {bad}: spark={sr[bad]} duck={dr[bad]}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from lapstats.session import build_session
    spark = build_session()
    if os.environ.get("LAPSTATS_SMALL_BYTES") is not None:  # e.g. 0 forces every distributed path
        spark.conf.set("spark.lapstats.smallInputBytes", os.environ["LAPSTATS_SMALL_BYTES"])
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and keep going
            r = {"name": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
