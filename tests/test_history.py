"""SCD2 history, as-of lookup and per-key picks on small literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from lodgelake.operators import scd2
from lodgelake.operators.dedupe import first_per_key, latest_per_key

D = dt.date
ATTRS = ["area", "flag"]


def src(spark, rows):
    df = spark.createDataFrame(rows, "k long, area string, flag string, d date")
    return df.withColumn("updated_at", F.col("d").cast("timestamp_ntz"))


def versions(df):
    return sorted((r.k, r.area, r.flag, r.valid_from.date(), r.valid_to.date() if r.valid_to else None)
                  for r in df.collect())


def test_build_history_rules(spark):
    rows = [
        (1, "a", "t", D(2020, 1, 1)),
        (1, "a", "t", D(2020, 2, 1)),   # unchanged attributes, newer date: new version
        (1, "b", None, D(2020, 3, 1)),  # two attribute sets on one date: greatest wins
        (1, "b", "f", D(2020, 3, 1)),   # ... NULL is lowest, so 'f' beats NULL
        (1, "a", "z", D(2020, 3, 1)),
        (2, "c", "t", D(2020, 1, 5)),
    ]
    h = scd2.build_history(src(spark, rows), "k", ATTRS)
    assert versions(h) == [
        (1, "a", "t", D(2020, 1, 1), D(2020, 2, 1)),
        (1, "a", "t", D(2020, 2, 1), D(2020, 3, 1)),
        (1, "b", "f", D(2020, 3, 1), None),
        (2, "c", "t", D(2020, 1, 5), None),
    ]


def test_versions_disjoint_one_open(spark):
    rows = [(k, f"x{d % 3}", "t", D(2020, 1, 1) + dt.timedelta(days=d * k)) for k in range(1, 6)
            for d in range(20)]
    h = scd2.build_history(src(spark, rows), "k", ATTRS)
    per_key = {}
    for r in h.collect():
        per_key.setdefault(r.k, []).append((r.valid_from, r.valid_to))
    for k, vs in per_key.items():
        vs.sort()
        assert sum(1 for _, to in vs if to is None) == 1
        for (f1, t1), (f2, _) in zip(vs, vs[1:]):
            assert t1 == f2  # gap-free and disjoint


def test_incremental_equals_rebuild(spark):
    rows = [(k, f"a{(k + d) % 4}", "t" if d % 2 else "f", D(2020, 1, 1) + dt.timedelta(days=7 * d))
            for k in range(1, 8) for d in range(12)]
    full = scd2.build_history(src(spark, rows), "k", ATTRS)
    s = src(spark, rows)
    h = scd2.build_history(s.where(F.col("d") < D(2020, 2, 1)), "k", ATTRS)
    for lo, hi in [(D(2020, 2, 1), D(2020, 3, 1)), (D(2020, 3, 1), D(2021, 1, 1))]:
        batch = s.where((F.col("d") >= lo) & (F.col("d") < hi))
        h = scd2.apply_batch(h, batch, "k", ATTRS)
    assert versions(h) == versions(full)


def test_apply_ignores_older_and_closes_vanished(spark):
    base = scd2.build_history(src(spark, [(1, "a", "t", D(2020, 5, 1)), (2, "b", "t", D(2020, 5, 1))]),
                              "k", ATTRS)
    batch = src(spark, [(1, "old", "t", D(2020, 4, 1))])  # older than the open version of key 1
    out = scd2.apply_batch(base, batch, "k", ATTRS, invalidate_hard_deletes=True,
                           as_of=F.lit("2020-06-01 00:00:00").cast("timestamp_ntz"))
    assert versions(out) == [(1, "a", "t", D(2020, 5, 1), None),
                             (2, "b", "t", D(2020, 5, 1), D(2020, 6, 1))]


def test_asof_boundaries(spark):
    h = scd2.build_history(src(spark, [(1, "a", "t", D(2020, 1, 10)), (1, "b", "t", D(2020, 3, 10))]),
                           "k", ATTRS)
    facts = spark.createDataFrame(
        [(1, D(2020, 1, 9)), (1, D(2020, 1, 10)), (1, D(2020, 3, 9)), (1, D(2020, 3, 10)),
         (1, D(2024, 1, 1)), (2, D(2020, 2, 1)), (None, D(2020, 2, 1))], "k long, d date")
    got = sorted(((r.k or -1), r.d, r.area) for r in scd2.asof_join(facts, h, "k", "d", ["area"]).collect())
    assert got == [(-1, D(2020, 2, 1), None), (1, D(2020, 1, 9), None), (1, D(2020, 1, 10), "a"),
                   (1, D(2020, 3, 9), "a"), (1, D(2020, 3, 10), "b"), (1, D(2024, 1, 1), "b"),
                   (2, D(2020, 2, 1), None)]


def test_asof_buckets_with_a_hot_key(spark):
    """One key with a third of all rows, each at its own instant: the same rows
    as by brute force, and no window of more than a bucket's rows."""
    import bisect
    import random
    rnd, start = random.Random(5), dt.datetime(2020, 1, 1)
    at = lambda s: start + dt.timedelta(seconds=s)
    day = 86_400
    starts = {k: sorted(rnd.sample(range(60 * day), 700 if k == 0 else 4)) for k in range(200)}
    starts[7] = []  # a key without versions
    starts[8] = [90 * day]  # one whose versions come after all facts
    history = spark.createDataFrame(
        [(k, f"{k}-{a}", at(a), at(b) if b is not None else None)
         for k, ss in starts.items() for a, b in zip(ss, [*ss[1:], None])],
        "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    history = history.where("not (k = 3 and valid_to is null)")  # key 3 is closed for good
    facts = [(0, s) for s in rnd.sample(range(60 * day), 3000)] + [
        (rnd.randrange(1, 200), rnd.randrange(60 * day)) for _ in range(6000)] + [(0, s) for s in starts[0][:50]]
    facts = [(k, at(s)) for k, s in sorted(set(facts))] + [(None, at(5)), (4, None)]
    probe = spark.createDataFrame(facts, "k long, t timestamp_ntz")

    def valid(k, t):
        if k is None or t is None:
            return None
        s = (t - start).total_seconds()
        i = bisect.bisect_right(starts[k], s) - 1
        return None if i < 0 or (k == 3 and i == len(starts[k]) - 1) else f"{k}-{starts[k][i]}"

    want = sorted((repr((k, t, valid(k, t))) for k, t in facts))
    for bucket in ("hour", "day", "year"):
        for bounded in (True, False):
            got = scd2.asof_join(probe, history, "k", "t", ["v"], bounded_per_key=bounded, bucket=bucket)
            assert sorted(repr((r.k, r.t, r.v)) for r in got.select("k", "t", "v").collect()) == want, (bucket, bounded)
    per = probe.where("k = 0").groupBy(F.date_trunc("day", F.col("t").cast("timestamp"))).count().agg(F.max("count")).first()[0]
    assert per < 120  # of 3050 rows of the key
    inner = scd2.asof_join(probe, history, "k", "t", ["v"], how="inner", bounded_per_key=True, bucket="day")
    assert inner.count() == sum(not w.endswith("None)") for w in want)


def test_first_per_key_null_keys_never_conflict(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (None, 1, "n1"), (None, 2, "n2")],
                               "k long, o long, v string")
    got = sorted((r.k or -1, r.v) for r in first_per_key(df, ["k"], ["o"]).collect())
    assert got == [(-1, "n1"), (-1, "n2"), (1, "y")]
    got = sorted((r.k, r.v) for r in latest_per_key(df.where("k is not null"), ["k"], ["o"]).collect())
    assert got == [(1, "x")]


def test_monthly_fact_feeds_both_marts(spark):
    from lodgelake.plans import marts
    from lodgelake.plans.layers import Layers
    L = Layers(spark, "/root/testdata/sf0.001")
    month = marts.monthly_fact(L.fact, L.property_history, L.host_history)
    a = marts.listing_neighbourhood_kpis(month)
    b = marts.mart_listing_neighbourhood(L.fact, L.property_history, L.host_history)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    c = marts.property_type_kpis(month)
    d = marts.mart_property_type(L.fact, L.property_history, L.host_history)
    assert sorted(map(tuple, c.collect()), key=str) == sorted(map(tuple, d.collect()), key=str)


def test_exact_median_matches_percentile(spark):
    import random
    from lodgelake.operators.median import exact_median
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(1, 40)) for _ in range(500)]
    rows += [("one", 7), ("two", 1), ("two", 4)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r.median for r in exact_median(df, ["g"], F.col("v")).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got == want


def test_materialised_warehouse_gives_same_answers(spark):
    from lodgelake.plans import analysis, marts
    from lodgelake.plans.layers import Layers, MaterialisedLayers
    from lodgelake.session import scratch_path
    raw = Layers(spark, "/root/testdata/sf0.001")
    mat = MaterialisedLayers.build(raw, scratch_path(spark, "wh"))

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    for L_fn in (
        lambda L: analysis.top_bottom_demographics(L.listings, L.lga_suburb, L.lga_code,
                                                   L.census_g01, L.census_g02),
        lambda L: analysis.mortgage_coverage(L.listings, L.lga_suburb, L.lga_code, L.census_g02),
        lambda L: analysis.best_listing_type(L.listings),
        lambda L: marts.mart_host_neighbourhood(L.fact, L.host_history, L.lga_suburb),
    ):
        assert rows(L_fn(raw)) == rows(L_fn(mat))
    assert rows(mat.mart_host_neighbourhood()) == rows(
        marts.mart_host_neighbourhood(raw.fact, raw.host_history, raw.lga_suburb))
    assert rows(mat.mart_property_type()) == rows(
        marts.mart_property_type(raw.fact, raw.property_history, raw.host_history))
    assert rows(mat.mart_listing_neighbourhood()) == rows(marts.listing_neighbourhood_kpis(mat.fact_month))
    assert rows(marts.listing_neighbourhood_kpis(mat.fact_month)) == rows(
        marts.mart_listing_neighbourhood(raw.fact, raw.property_history, raw.host_history))


def test_batch_is_merged_by_one_shuffle_of_open_versions(spark):
    """Fresh, stale, absent and untimed keys; closed versions move nowhere."""
    day = lambda n: dt.datetime(2020, 1, n)
    kind = "k long, a string, updated_at timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz"
    history = spark.createDataFrame([
        (1, "a", day(1), day(1), day(2)), (1, "b", day(2), day(2), None), (2, "c", day(5), day(5), None),
        (3, "d", day(1), day(1), day(3)), (4, "e", day(1), day(1), None), (5, "f", day(1), day(1), None),
        (None, "n", day(1), day(1), None)], kind)
    batch = spark.createDataFrame([
        (1, "x", day(2)), (1, "y", day(4)), (1, "z", day(6)), (2, "c", day(4)), (3, "g", day(2)), (3, "h", day(3)),
        (5, "u", None), (6, "w", day(1)), (None, "m", day(8))], "k long, a string, updated_at timestamp_ntz")
    out = scd2.apply_batch(history, batch, "k", ["a"], invalidate_hard_deletes=True)
    rows = {(r.k, r.a): (r.valid_from, r.valid_to) for r in out.collect()}
    assert rows == {
        (1, "a"): (day(1), day(2)), (1, "b"): (day(2), day(4)), (1, "y"): (day(4), day(6)), (1, "z"): (day(6), None),
        (2, "c"): (day(5), None), (3, "d"): (day(1), day(3)), (3, "h"): (day(3), None), (4, "e"): (day(1), day(8)),
        (5, "f"): (day(1), None), (6, "w"): (day(1), None), (None, "n"): (day(1), day(8))}
    assert " Join " not in out._jdf.queryExecution().optimizedPlan().toString()
