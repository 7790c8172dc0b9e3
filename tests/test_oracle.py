"""Every registered query equals its DuckDB oracle (sf0.001): same columns,
same rows in any order.  This is the check the driver runs at sf0.01."""

import math
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import types as T

from lodgelake.plans.catalog import ORACLE, QUERIES, load_all

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _sql_type(t):
    names = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
             T.StringType: "VARCHAR", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
             T.BooleanType: "BOOLEAN"}
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return names.get(type(t), str(t))


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    got = _rows(df.columns, df.collect())
    assert key in ORACLE
    rel = con.execute(ORACLE[key])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = _rows(cols, rel.fetchall())
    assert len(got) == len(want)
    assert got == want
    empty = con.sql(f"SELECT * FROM ({ORACLE[key]}) LIMIT 0")
    types = dict(zip(empty.columns, map(str, empty.types)))
    assert {f.name: _sql_type(f.dataType) for f in df.schema.fields} == types
