"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the correctness gate: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def table_hash(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
    return h.hexdigest()


def compare(spark, con, name: str, builder, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    type_diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows), "type_diff": type_diff,
           "cols_match": sorted(scols) == sorted(dcols), "spark_sec": round(t1 - t0, 2)}
    if not out["cols_match"]:
        out["cols"] = (sorted(scols), sorted(dcols))
    out["hash_match"] = out["cols_match"] and table_hash(scols, srows) == table_hash(dcols, drows)
    if out["cols_match"] and not out["hash_match"]:
        # find first differing row for debugging
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        a = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
        b = sorted(repr(tuple(_norm(r[i]) for i in order_d)) for r in drows)
        sa, sb = set(a), set(b)
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_duck"] = [x for x in b if x not in sa][:3]
        out["sorted_cols"] = sorted(scols)
    return out


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from panelrank.plans import registry
    from panelrank.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = registry.queries(), registry.oracle_sql()
    bad = ok = rows_only = 0
    for name in (names or list(qs)):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            rows_only += 1
            print(f"{name:38s} rows-only {n}")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:38s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        good = r["hash_match"] and r["spark_rows"] == r["duck_rows"]
        bad += not good
        ok += good
        print(f"{name:38s} {'OK ' if good else 'BAD'} rows {r['spark_rows']}/{r['duck_rows']} "
              f"{r['spark_sec']}s" + ("" if good else f" {r}") + (f" TYPES {r['type_diff']}" if r["type_diff"] else ""))
    print(f"equal: {ok}  rows-only: {rows_only}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
