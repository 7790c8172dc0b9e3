"""The pipeline against its stages' plain versions, and its edge cases."""

import corpus_pipeline
from lodgelake.llm import lines, mixing, quality
from tests.llm.conftest import SF
from tests.llm.test_scoring import plain_counts
from tests.llm.test_similarity import plain_components, plain_contamination, plain_fingerprint


def test_run_against_plain_stages(spark):
    """Learnt verdicts come from the operators' own scores on the same input;
    dedup, contamination and copies are worked out by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    whole, docs = docs, docs.where(docs.doc_id.isin(list(good)))
    verdicts = [r for r in lines.apply_rules(whole, labels).collect() if r.doc_id in good]  # learnt from all, as run() does
    text_of = {r.doc_id: r.text for r in docs.collect()}
    for r in verdicts:
        assert r.base_failed == plain_counts(text_of[r.doc_id])[-1]
    kept = sorted(r.doc_id for r in verdicts if r.kept)
    root = plain_components([plain_fingerprint(text_of[k]) for k in kept])
    single = [k for i, k in enumerate(kept) if root[i] == i]
    dirty = {r[0] for r in plain_contamination([(k, text_of[k]) for k in single], items) if r[-1]}
    clean = [k for k in single if k not in dirty]
    assert 0 < len(clean) < len(single) < len(kept) < len(text_of)
    want = mixing.replicate(docs.where(docs.doc_id.isin(clean)))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_stages_keep_columns_and_bear_odd_tables(spark, docs_of, tmp_path):
    long = " ".join(f"word{i} is here" for i in range(60))
    rows = [(None, long), (1, long), (1, long), (2, None), (3, ""), (4, "x " * 20_000), (5, long + " more")]
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for made in (rows, []):
        docs = docs_of(made, extra=True)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == docs_of([], extra=True).columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        ids = {r.doc_id for r in docs.collect()}  # row 5 may or may not be a near copy of 1
        assert docs.count() == len(ids) and ids - {5} == ({1} if made else set())
        assert {r.doc_id for r in out.collect()} <= ids


def test_boilerplate_that_stage_1_keeps_is_rejected_by_stage_2(spark):
    """The line labels are learnt from the whole table: what stage 1 leaves has
    one class, from which no boilerplate can be told."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = docs.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    bad = docs.join(labels.where("quality = 0").select("doc_id"), "doc_id").selectExpr(
        "doc_id + 1000000000 AS doc_id", *docs.columns[1:])  # without a label
    texts = {r.doc_id: r.text for r in bad.collect()}
    passing = {k for k, t in texts.items() if not plain_counts(t)[-1]}
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, good.unionByName(bad), sf).collect()}
    assert passing and not passing & kept
    assert len(kept) >= 0.95 * good.count()


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "simhash near-dedup", "benchmark decontamination", "mixing"]
