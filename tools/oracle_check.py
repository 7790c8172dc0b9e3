"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key ...]
Mirrors the driver's check: same column names, same row count, same rows
(order-insensitive).  Prints one line per key.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

sys.path.insert(0, ".")

import duckdb  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from lodgelake.plans.catalog import ORACLE, QUERIES, load_all  # noqa: E402
from lodgelake.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, Decimal):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def sql_type(t) -> str:
    """DuckDB's name for a Spark type (for the schema comparison)."""
    names = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
             T.StringType: "VARCHAR", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
             T.BooleanType: "BOOLEAN"}
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return names.get(type(t), str(t))


def rows_of(records):
    return sorted((tuple(norm(x) for x in r) for r in records),
                  key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    load_all()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    keys = keys or sorted(QUERIES)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = QUERIES[k](spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"{k:34s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in ORACLE:
            print(f"{k:34s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.execute(ORACLE[k])
            ocols = [d[0] for d in rel.description]
            orows = rel.fetchall()
            otypes = dict(zip(con.sql(f"SELECT * FROM ({ORACLE[k]}) LIMIT 0").columns,
                              map(str, con.sql(f"SELECT * FROM ({ORACLE[k]}) LIMIT 0").types)))
        except Exception as e:
            print(f"{k:34s} SQL-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"{k:34s} COLUMNS differ spark={cols} sql={ocols}")
            bad += 1
            continue
        order = [ocols.index(c) for c in sorted(cols)]
        sorder = [cols.index(c) for c in sorted(cols)]
        a = rows_of([tuple(r[i] for i in sorder) for r in srows])
        b = rows_of([tuple(r[i] for i in order) for r in orows])
        types_ok = all(sql_type(f.dataType) == otypes.get(f.name) for f in df.schema.fields)
        ok = a == b and types_ok
        msg = "OK" if ok else ("MISMATCH" if a != b else "TYPES")
        print(f"{k:34s} {msg} rows spark={len(a)} sql={len(b)} {ts:.1f}s")
        if not ok:
            bad += 1
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diffs:
                print("   spark:", x)
                print("   sql:  ", y)
    print(f"done: {len(keys)} keys, {bad} bad")


if __name__ == "__main__":
    main()
