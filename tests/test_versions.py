"""Tables that change together: commits, stopped runs, open and closed versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodgelake.operators import scd2
from lodgelake.plans import layers as layers_module
from lodgelake.plans.layers import CURRENT, merge_history, put_history
from lodgelake.plans.versions import VersionedTables
from lodgelake.session import scratch_path
from lodgelake.sources import files

ROWS = "k long, a string, scraped_date date, updated_at timestamp_ntz"


def rows_of(spark, rows):
    at = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    return spark.createDataFrame([(k, a, at(n).date(), at(n)) for k, a, n in rows], ROWS)


def versions(df):
    return sorted(map(repr, df.select("k", "a", "valid_from", "valid_to").collect()))


def test_readers_see_a_commit_or_the_one_before(spark):
    base = scratch_path(spark, "v")
    first = VersionedTables(spark, base)
    first.put("t", spark.range(3).withColumn("m", F.col("id") % 2), "m")
    assert VersionedTables(spark, base).committed is None
    first.commit(months=1)
    second = VersionedTables(spark, base)
    second.put("t", spark.range(10, 12).withColumn("m", F.lit(1).cast("long")), "m", keep=lambda v: v != "1")
    ids = lambda t: sorted(r.id for r in t.read("t").collect())
    assert ids(VersionedTables(spark, base)) == [0, 1, 2] and ids(second) == [0, 2, 10, 11]
    rival = VersionedTables(spark, base)
    second.commit(months=2)
    with pytest.raises(RuntimeError, match="another run"):
        rival.commit()
    last = VersionedTables(spark, base)
    assert ids(last) == [0, 2, 10, 11] and last.notes() == {"months": 2}
    last.put("t", spark.range(0).withColumn("m", F.col("id")), "m")
    last.commit()
    assert ids(VersionedTables(spark, base)) == []
    last.vacuum(keep=1)
    assert len(files.list_files(spark, f"{base}/t")) == 0 and ids(VersionedTables(spark, base)) == []


def test_a_merge_writes_open_versions_and_what_it_closes(spark):
    base = scratch_path(spark, "v")
    t = VersionedTables(spark, base)
    old = [(k, f"a{n}", n) for k in range(50) for n in range(20)]
    put_history(t, "h", scd2.build_history(rows_of(spark, old), "k", ["a"]))
    t.commit()
    t = VersionedTables(spark, base)
    closed = [f for f in t.tables["h"]["folders"]]
    new = [(k, "b", 30) for k in range(10)] + [(99, "n", 30)]
    merged = merge_history(t, "h", rows_of(spark, new), "k", ["a"], late=False)
    assert versions(merged) == versions(scd2.build_history(rows_of(spark, old + new), "k", ["a"]))
    written = [f for f in t.tables["h"]["folders"] if not f.startswith(closed[0])]
    assert [f.rsplit("/", 1)[1] for f in t.tables["h"]["folders"] if f.startswith(closed[0])] == [f"{CURRENT}=false"]
    sizes = {f.rsplit("=", 1)[1]: spark.read.parquet(f"{base}/{f}").count() for f in written}
    assert sizes == {"false": 10, "true": 51}  # 950 older closed versions stay where they are
    plan = t.read("h").where(CURRENT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def test_a_splice_equals_a_rebuild_and_keeps_other_keys(spark):
    old = [(k, f"a{n}", n) for k in range(6) for n in (0, 10, 20)]
    late = [(1, "z", 5), (1, "zz", 5), (2, "y", 10), (7, "n", 3), (1, "a0", 0)]
    history = scd2.build_history(rows_of(spark, old), "k", ["a"])
    got = scd2.splice(history, rows_of(spark, late), "k", ["a"])
    assert versions(got) == versions(scd2.build_history(rows_of(spark, old + late), "k", ["a"]))
    assert versions(scd2.splice(got, rows_of(spark, late), "k", ["a"])) == versions(got)


def test_stream_epochs_are_merged_once(spark):
    from lodgelake.streaming import monthly
    base = scratch_path(spark, "v")
    source = layers_module.Layers(spark, "/root/testdata/sf0.001").listings
    early, late = source.where("scraped_date < '1995-06-01'"), source.where("scraped_date >= '1995-06-01' and scraped_date < '1996-01-01'")
    monthly.merge_histories(spark, late, 0, base)
    monthly.merge_histories(spark, early, 1, base)
    number = VersionedTables(spark, base).number
    monthly.merge_histories(spark, early, 1, base)  # a replay
    t = VersionedTables(spark, base)
    assert t.number == number
    want = layers_module.star.host_history(early.union(late))
    assert sorted(map(repr, t.read("host_history").select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_a_run_stopped_after_any_write_changes_nothing(spark, monkeypatch):
    """``update`` is stopped after its 1st, 2nd, ... write; each time readers see
    the old tables, and the run that is not stopped gives a full build's."""
    bronze, base = scratch_path(spark, "bronze"), scratch_path(spark, "wh")
    full = layers_module.Layers(spark, "/root/testdata/sf0.001")
    raw = full.bronze["airbnb_raw"].where("scraped_date < '1995-05-01'").withColumn("scrape_month", F.trunc("scraped_date", "month"))
    raw.where("scraped_date < '1995-04-01'").write.partitionBy("scrape_month").parquet(bronze)
    tables = lambda: layers_module.Layers(spark, bronze={**full.bronze, "airbnb_raw": spark.read.parquet(bronze).drop("scrape_month")})
    layers_module.MaterialisedLayers.build(tables(), base)
    before = {n: VersionedTables(spark, base).tables[n]["folders"] for n in ("listings", "host_history", "fact_month", "neighbourhood_month", "host_area_month")}
    raw.where("scraped_date >= '1995-04-01'").write.partitionBy("scrape_month").mode("append").parquet(bronze)
    put, writes = VersionedTables.put, []

    def stopping(self, *args, **kw):
        if len(writes) == limit:
            raise KeyboardInterrupt
        writes.append(args[0])
        return put(self, *args, **kw)

    monkeypatch.setattr(VersionedTables, "put", stopping)
    for limit in (1, 4, 7, 15):
        writes.clear()
        with pytest.raises(KeyboardInterrupt):
            layers_module.MaterialisedLayers.update(tables(), base, bronze)
        now = VersionedTables(spark, base)
        assert {n: now.tables[n]["folders"] for n in before} == before
    limit = -1
    layers_module.MaterialisedLayers.update(tables(), base, bronze)
    now = VersionedTables(spark, base).tables
    for n in ("neighbourhood_month", "property_month", "host_area_month"):  # the months before keep their files
        assert len([f for f in now[n]["folders"] if f"/v={1:06d}-" in f]) == 3 and len(now[n]["folders"]) == 4
    fresh = scratch_path(spark, "fresh")
    layers_module.MaterialisedLayers.build(tables(), fresh)
    for name in layers_module.MaterialisedLayers.TABLES:
        a, b = (VersionedTables(spark, x).read(name) for x in (base, fresh))
        assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name


def test_a_month_of_mart_parts_reads_its_own_facts(spark, monkeypatch):
    base = scratch_path(spark, "wh")
    full = layers_module.Layers(spark, "/root/testdata/sf0.001")
    raw = full.bronze["airbnb_raw"].where("scraped_date < '1995-04-01'")
    layers_module.MaterialisedLayers.build(layers_module.Layers(spark, bronze={**full.bronze, "airbnb_raw": raw}), base)
    t, plans, put = VersionedTables(spark, base), [], VersionedTables.put
    want = {n: sorted(map(repr, t.read(n).collect())) for n in ("neighbourhood_month", "property_month", "host_area_month")}

    def planned(self, name, df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, name, df, *rest)

    monkeypatch.setattr(VersionedTables, "put", planned)
    layers_module.put_mart_parts(t, ["1995-02-01"])
    assert {n: sorted(map(repr, t.read(n).collect())) for n in want} == want
    for plan in plans:  # every scan of facts has the month as a partition filter
        facts = [s for s in plan.split("FileScan parquet")[1:] if "/fact" in s]
        assert facts and all("month" in s.split("PartitionFilters: [")[1].split("]")[0] for s in facts)
