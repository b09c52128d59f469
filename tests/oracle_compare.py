"""Run a Spark query and its DuckDB oracle on the same parquet tables and
compare row count, column names/types and an order-insensitive value hash.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return repr(v)


def value_hash(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, sf_dir, name, query, sql):
    t0 = time.time()
    df = query(spark, sf_dir)
    s_types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    s_names = [n for n, _ in s_types]
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["names_match"] = sorted(s_names) == sorted(d_names)
    type_issues = []
    dt_map = dict(zip(d_names, d_types))
    for n, t in s_types:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        got = dt_map.get(n)
        if got is None or (want != got and not (t.startswith("decimal") and got.startswith("DECIMAL"))):
            type_issues.append((n, t, got))
    out["type_issues"] = type_issues
    hs, ls = value_hash(s_names, s_rows)
    hd, ld = value_hash(d_names, d_rows)
    out["hash_match"] = hs == hd
    if hs != hd:
        a, b = set(ls), set(ld)
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as e
    from marketpulse.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = e.queries(), e.oracle_sql()
    ok = True
    for name, q in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in oracle:
            df = q(spark, sf_dir)
            print({"query": name, "rows": df.count(), "oracle": None})
            continue
        r = compare(spark, con, sf_dir, name, q, oracle[name])
        good = r["hash_match"] and r["names_match"] and not r["type_issues"] and r["spark_rows"] == r["oracle_rows"]
        ok &= good
        print(("PASS " if good else "FAIL ") + str(r), flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
