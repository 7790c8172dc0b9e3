import re

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    """A-Z only."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows,
    with further columns whose names clash with result columns."""
    def make(rows, extra=False):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for c in ("score", "n_words", "fingerprint", "row_id", "copies", "kept", "lang_pred", "words"):
                df = df.withColumn(c, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def con():
    import duckdb
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c
