"""Operators that SQL expresses equal their DuckDB form; all registered queries
run over whole tables and have one row per input row where they promise that."""

import pytest

from lodgelake.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in data)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equals_sql(spark, con, key):
    df = QUERIES[key](spark, SF)
    want = con.execute(ORACLE[key])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows(cols, want.fetchall())


@pytest.mark.parametrize("key,table", [
    ("op1_quality", "documents"), ("op2_decontaminate", "documents"), ("op3_licenses", "documents"),
    ("op4_warc", "pages"), ("op5_language", "documents"), ("op6_url_tree", "pages"),
    ("op7_line_rules", "documents"), ("op8_simhash", "documents"), ("op9_token_counts", "documents"),
    ("op13_minhash", "documents")])
def test_one_row_each(spark, con, key, table):
    ident = "page_id" if table == "pages" else "doc_id"
    got = sorted(r[0] for r in QUERIES[key](spark, SF).select(ident).collect())
    assert got == sorted(r[0] for r in con.execute(f"select {ident} from {table}").fetchall())


def test_all_operators_and_pipeline_are_registered():
    numbers = {int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES
