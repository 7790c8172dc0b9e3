"""Loaders on untidy drops, history merges, and the session on a cluster."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lodgelake import __main__ as cli
from lodgelake import schemas, session
from lodgelake.functions import parse_date_cascade, parse_date_dayfirst, parse_date_month_locked
from lodgelake.operators import scd2
from lodgelake.session import scratch_path
from lodgelake.sources import files, ingest

D = dt.date


def drop(spark, land, name, rows, order=None, without=()):
    """Write one CSV drop by hand: rows are dicts of the cells that matter."""
    cols = [c for c in (order or schemas.LISTING_COLUMNS) if c not in without]
    cell = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [",".join(f" {c.upper()} " for c in cols)]
    lines += [",".join(cell(r.get(c, "")) for c in cols) for r in rows]
    fs, p = files._fs(spark, land)
    fs.mkdirs(p)
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, name))
    out.write(bytearray("\n".join(lines).encode() + b"\n"))
    out.close()


def row(listing, date, **cells):
    return {"listing_id": str(listing), "scraped_date": date, **cells}


def test_columns_are_matched_by_name(spark):
    land = scratch_path(spark, "land")
    swapped = list(schemas.LISTING_COLUMNS)
    i, j = swapped.index("host_name"), swapped.index("scraped_date")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    drop(spark, land, "a_05_2020.csv", [row(1, "07/05/2020", host_name="Ann")])
    drop(spark, land, "b_05_2020.csv", [row(2, "08/05/2020", host_name="Bob")], order=swapped)
    text = ingest.read_csv_text(spark, [f"{land}/a_05_2020.csv", f"{land}/b_05_2020.csv"], schemas.LISTING_COLUMNS)
    got = {(r.listing_id, r.host_name, r.scraped_date) for r in ingest.type_listings(text).collect()}
    assert got == {(1, "Ann", D(2020, 5, 7)), (2, "Bob", D(2020, 5, 8))}
    drop(spark, land, "c_05_2020.csv", [row(3, "08/05/2020")], without=["price"])
    with pytest.raises(ValueError, match="price"):
        ingest.read_csv_text(spark, [f"{land}/a_05_2020.csv", f"{land}/c_05_2020.csv"], schemas.LISTING_COLUMNS)


def test_quotes_line_breaks_and_whole_numbers(spark):
    land = scratch_path(spark, "land")
    drop(spark, land, "a_05_2020.csv", [
        row("1234567.0", "07/05/2020", host_name='The "Loft", Bondi', accommodates="2.0", number_of_reviews="2.5"),
        row("8", "08/05/2020", host_name="two\nlines", accommodates="3", number_of_reviews="99999999999")])
    text = ingest.read_csv_text(spark, [f"{land}/a_05_2020.csv"])
    got = sorted((r.listing_id, r.host_name, r.accommodates, r.number_of_reviews) for r in ingest.type_listings(text).collect())
    assert got == [(8, "two\nlines", 3, None), (1234567, 'The "Loft", Bondi', 2, None)]


def test_second_file_of_a_loaded_month(spark):
    """Only the new file is read; each file stands in the ledger once."""
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    bronze, ledger = f"{wh}/b", f"{wh}/l"
    drop(spark, land, "a_04_2020.csv", [row(1, "07/04/2020", host_name="Ann")])
    ingest.load_next_month(spark, land, bronze, ledger, scratch_path(spark, "s"))
    drop(spark, land, "b_04_2020.csv", [row(1, "07/04/2020", host_name="Eve"), row(2, "04/09/2020")])
    ingest.load_next_month(spark, land, bronze, ledger, scratch_path(spark, "s"))
    assert ingest.load_next_month(spark, land, bronze, ledger, scratch_path(spark, "s")) is None
    assert sorted(r.file_name for r in spark.read.parquet(ledger).collect()) == ["a_04_2020.csv", "b_04_2020.csv"]
    got = sorted((r.listing_id, r.scraped_date, r.host_name) for r in ingest.read_bronze(spark, bronze).collect())
    assert got == [(1, D(2020, 4, 7), "Ann"), (2, D(2020, 4, 9), "Unknown")]


def test_bulk_drop_without_valid_rows_is_retried(spark):
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    drop(spark, land, "a_04_2020.csv", [row(1, "31/02/2020")])
    cli.load(spark, land, wh, monthly=False)
    assert ingest.table_or_none(spark, f"{wh}/bronze/_ledger") is None
    drop(spark, land, "b_05_2020.csv", [row(2, "01/05/2020")])
    cli.load(spark, land, wh, monthly=False)  # a_04 is read again, still bad: not recorded
    assert [r.file_name for r in spark.read.parquet(f"{wh}/bronze/_ledger").collect()] == ["b_05_2020.csv"]
    assert [r.listing_id for r in ingest.read_bronze(spark, f"{wh}/bronze/airbnb_raw").collect()] == [2]


def test_one_csv_scan_per_batch(spark):
    """Counts, range and anti-join read the staged batch."""
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    drop(spark, land, "a_04_2020.csv", [row(1, "07/04/2020")])
    counts = ingest.load_files(spark, land, ["a_04_2020.csv"], f"{wh}/b", f"{wh}/s", True)
    assert "csv" not in counts._jdf.queryExecution().executedPlan().toString().lower().replace(".csv", "")


def test_dates_in_every_layout(spark):
    texts = ["07/04/2020", "7-4-2020", "07-04-2020", "2020-04-07T10:00:00", "2020-04-07 00:00:00", "7 Apr 2020",
             "7 April 2020", "Apr 7, 2020", "2020/04/07", "2020-04-07", "13-04-2020", "04/27/2020"]
    apr, jul = D(2020, 4, 7), D(2020, 7, 4)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, s string").select(
        "k", parse_date_cascade(F.col("s")).alias("c"), parse_date_dayfirst(F.col("s")).alias("d"),
        parse_date_month_locked(F.col("s"), F.lit(4)).alias("m"))
    got = [tuple(r)[1:] for r in df.orderBy("k").collect()]
    certain = [(apr, apr, apr)] * 7
    assert got == [(apr, apr, apr), (jul, apr, apr), (jul, apr, apr), *certain, (D(2020, 4, 13),) * 3, (D(2020, 4, 27),) * 3]


def test_merges_keep_versions_disjoint(spark):
    """Vanishing and returning keys, late months and replays."""
    rng = random.Random(9)
    make = lambda rows: spark.createDataFrame(rows, "k long, a string, updated_at timestamp_ntz")
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    first = make([(k, "x", day(0)) for k in range(6)])
    history = scd2.build_history(first, "k", ["a"])
    seen = []
    for step in range(6):
        at = rng.choice([step * 30, max(0, (step - 2) * 30)])  # a late month now and then
        batch = [(k, rng.choice("xyz"), day(at + rng.randrange(5))) for k in rng.sample(range(8), 4)]
        if seen and rng.random() < 0.4:
            batch = rng.choice(seen)  # a replay
        seen.append(batch)
        stamp = F.lit(max(max(r[2] for r in b) for b in seen)).cast("timestamp_ntz")
        history = scd2.apply_batch(history, make(batch), "k", ["a"], invalidate_hard_deletes=True, as_of=stamp)
        history = spark.createDataFrame(history.collect(), history.schema)
    per = {}
    for r in history.collect():
        per.setdefault(r.k, []).append((r.valid_from, r.valid_to))
    for spans in per.values():
        spans.sort()
        assert sum(b is None for _, b in spans) <= 1
        assert all(b is not None and b <= c for (_, b), (c, _) in zip(spans, spans[1:])), spans


def test_earlier_row_of_a_closed_key_is_ignored(spark):
    ts = lambda m: dt.datetime(2020, m, 1)
    h = spark.createDataFrame([(1, "a", ts(1), ts(1), ts(6))],
                              "k long, a string, updated_at timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz")
    batch = spark.createDataFrame([(1, "b", ts(3)), (1, "c", ts(7))], "k long, a string, updated_at timestamp_ntz")
    got = sorted((r.a, r.valid_from, r.valid_to) for r in scd2.apply_batch(h, batch, "k", ["a"]).collect())
    assert got == [("a", ts(1), ts(6)), ("c", ts(7), None)]


@pytest.mark.parametrize("late", [False, True])
def test_update_writes_the_new_month_and_equals_a_rebuild(spark, late):
    from lodgelake.plans.layers import MaterialisedLayers
    from lodgelake.plans.q_ingest import landing
    from lodgelake.plans.versions import VersionedTables
    source = landing(spark, "/root/testdata/sf0.001")
    months = sorted({files.month_of_name(n) for n in files.select_files(files.list_files(spark, source)) if files.month_of_name(n)})
    order = [months[0], months[2], months[1]] if late else months[:3]
    wh = scratch_path(spark, "wh")
    bronze, ledger = f"{wh}/bronze/airbnb_raw", f"{wh}/bronze/_ledger"
    for kind in cli.CENSUS_KINDS:
        picked = files.select_files(files.list_files(spark, source), kind)
        ingest.full_refresh(f"{wh}/bronze/{kind}", ingest.read_census(spark, [f"{source}/{n}" for n in picked], kind))
    for month in order[:2]:
        ingest.load_month(spark, source, bronze, ledger, scratch_path(spark, "s"), month)
    cli.build(spark, wh, None)
    stamp = lambda m: {r[0] for r in VersionedTables(spark, f"{wh}/tables").read("listings").where(
        F.col("scrape_month") == dt.date(*m, 1)).select("_metadata.file_path").distinct().collect()}
    kept = stamp(order[0])
    ingest.load_month(spark, source, bronze, ledger, scratch_path(spark, "s"), order[2])
    cli.build(spark, wh, None)
    assert stamp(order[0]) == kept  # the month's files were not written again
    fresh = scratch_path(spark, "fresh")
    from lodgelake.plans.layers import Layers
    MaterialisedLayers.build(Layers(spark, bronze=cli.bronze_tables(spark, wh)), fresh)
    for name in MaterialisedLayers.TABLES:
        a, b = (VersionedTables(spark, base).read(name) for base in (f"{wh}/tables", fresh))
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name


def test_cli_keeps_the_session_it_is_given(spark, monkeypatch):
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"),
              spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    got = {}
    monkeypatch.setattr(cli, "build", lambda s, *rest: got.update(spark=s))
    cli.main(["build", "--warehouse", "w"])
    s = got["spark"]
    assert (s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"),
            s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == before


def test_checkpoint_folder_must_be_named_on_a_cluster():
    made = {}
    conf = SimpleNamespace(get=lambda k, d=None: made.get(k, d), set=made.__setitem__)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
    made["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context)) == "hdfs:///shared"


def test_median_with_one_area_holding_most_rows(spark):
    from lodgelake.operators.median import exact_median
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 9, F.lit(None).cast("string")).otherwise(F.lit("b")).alias("g"),
        (F.xxhash64("id") % 100_000).alias("v"))
    got = {r.g: r.median for r in exact_median(rows, ["g"], F.col("v")).collect()}
    want = {r.g: r.m for r in rows.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got == want


def test_best_listing_type_scans_listings_once(spark):
    from lodgelake.plans import analysis
    path = scratch_path(spark, "listings")
    spark.createDataFrame([(1, "Bondi", "flat", "whole", 2, 3, 100.0), (2, None, "flat", "whole", 2, 0, 900.0)],
                          "listing_id long, listing_neighbourhood string, property_type string, room_type string, "
                          "accommodates int, availability_30 int, price double").selectExpr(
        "* except (price)", "cast(price as decimal(18,2)) as price").write.parquet(path)
    best = analysis.best_listing_type(spark.read.parquet(path))
    assert best._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 2  # initial and final plan
    assert [r.listing_neighbourhood for r in best.collect()] == ["Bondi"]
