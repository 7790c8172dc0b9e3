"""Queries that did part of their job do the whole of it, and each step once."""

import time

import pytest

from lodgelake import schemas
from lodgelake.plans import q_ingest
from lodgelake.plans.catalog import ORACLE, QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.001"


def test_select_files_reads_the_files_it_selects(spark):
    got = QUERIES["select_files"](spark, SF)
    assert got.columns == schemas.CENSUS_G02.names and got.count() == 5
    assert "census_g02" in ORACLE["select_files"] and "picked" in ORACLE["file_kinds"]


def test_load_projection_loads_every_declared_column(spark):
    got = QUERIES["load_projection"](spark, SF)
    assert got.columns == schemas.LISTING_COLUMNS
    assert got.where("scraped_date is null").isEmpty()
    assert "loaded_rows" in ORACLE["load_projection"]


# each reads its listings two to four times
SEVERAL = ["mart_listing_neighbourhood", "mart_property_type", "mart_host_neighbourhood", "scd2_apply",
           "scd2_asof_join", "scd2_asof_unmatched", "scd2_double_asof", "coalesce_fallback"]


@pytest.mark.parametrize("key", SEVERAL)
def test_listings_are_mapped_once(spark, key):
    read = QUERIES[key](spark, SF).inputFiles()
    assert any("bronze-listings" in f for f in read) and not any("lineitem.parquet" in f for f in read)


def test_full_refresh_lands_no_listings(spark, monkeypatch):
    monkeypatch.setattr(q_ingest, "landing", lambda *_: pytest.fail("listings landed"))
    assert QUERIES["full_refresh"](spark, SF).count() == 5


def test_landed_copies_of_a_key_share_a_file(spark):
    paths = q_ingest._listing_paths(spark, SF)
    text = q_ingest.ingest.read_csv_text(spark, paths, schemas.LISTING_COLUMNS)
    good = text.where("scraped_date not like '31/02%'")
    assert good.groupBy("listing_id", "scraped_date").agg({"_file": "approx_count_distinct"}).where("`approx_count_distinct(_file)` > 1").isEmpty()


def test_line_items_are_not_shuffled_by_customer(spark):
    plan = q_ingest.testdata.joined_rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_partkey" in joins[0] and "l_orderkey" in joins[1] and len(joins) == 4  # customers join their orders below


def test_listings_of_some_columns_are_those_of_all(spark):
    """The pick takes the same rows whatever columns are read, and moves no others."""
    from lodgelake.plans import star

    bronze = q_ingest.testdata.bronze_listings
    whole = bronze(spark, SF)
    for columns in (["listing_id", "scraped_date", "number_of_reviews"], star.HOST_ROWS, [*star.PROPERTY_ROWS, "price"]):
        some = bronze(spark, SF, columns)
        assert some.exceptAll(whole.select(*some.columns)).isEmpty() and some.count() == whole.count()
    plan = bronze(spark, SF, star.HOST_ROWS)._jdf.queryExecution().optimizedPlan().toString()
    moved = "\n".join(line for line in plan.splitlines() if "Relation" not in line)
    assert "p_type" not in moved and "l_quantity" not in moved


def test_ties_of_the_load_order_are_picked_alike(spark):
    """Rows that the load order does not tell apart: all columns decide."""
    from lodgelake.plans import star
    from lodgelake.session import scratch_path

    sf = scratch_path(spark, "tied")
    for t in ("nation", "region", "supplier", "customer", "part", "orders", "lineitem"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "orders":  # every order twice, of two customers and dates
            df = df.union(df.withColumns({"o_custkey": df.o_custkey % 7 + 1, "o_orderdate": df.o_orderdate.cast("timestamp_ntz")}))
        df.write.parquet(f"{sf}/{t}.parquet")
    bronze = q_ingest.testdata.bronze_listings
    whole, some = bronze(spark, sf), bronze(spark, sf, star.HOST_ROWS)
    assert some.exceptAll(whole.select(*some.columns)).isEmpty() and some.count() == whole.count()


@pytest.fixture
def tables(spark):
    """Line items of four parts, several a day, from orders in no order."""
    from pyspark.sql import functions as F

    from lodgelake.session import scratch_path

    sf, n = scratch_path(spark, "tables"), F.col("id")
    made = {
        "nation": spark.sql("select * from values (0, 'PERU', 0), (1, 'CHINA', 1) t(n_nationkey, n_name, n_regionkey)"),
        "region": spark.sql("select * from values (0, 'AMERICA'), (1, 'ASIA') t(r_regionkey, r_name)"),
        "supplier": spark.range(4).select(n.alias("s_suppkey"), (n % 2).cast("int").alias("s_nationkey")),
        "customer": spark.range(9).select(n.alias("c_custkey"), F.concat(F.lit("C"), n).alias("c_name"),
                                          (n % 2).cast("int").alias("c_nationkey"), (n * 10.5).alias("c_acctbal")),
        "part": spark.range(4).select(n.alias("p_partkey"), F.lit("old hut").alias("p_name"), F.lit("FLAT").alias("p_type"),
                                      n.cast("int").alias("p_size")),
        "orders": spark.range(60).select(
            n.alias("o_orderkey"), (n % 9).alias("o_custkey"), F.lit("2019-01-01 05:00:00").cast("timestamp_ntz").alias("o_orderdate"),
            F.element_at(F.array(F.lit("1-URGENT"), F.lit("5-LOW"), F.lit("2-HIGH"), F.lit(None)), (n % 4 + 1).cast("int")).alias("o_orderpriority")),
        "lineitem": spark.range(400).select(
            (n * 7 % 60).alias("l_orderkey"), (n % 4).alias("l_partkey"), (n % 3).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
            (n % 5 + 1.0).alias("l_quantity"), (n * 3 % 11 + 0.5).alias("l_extendedprice"), (n % 9 / 100).alias("l_discount"),
            F.when(n % 3 == 0, "R").when(n % 3 == 1, "N").alias("l_returnflag"),
            F.timestamp_add("DAY", (n % 10 * 9).cast("int"), F.lit("2020-01-05 10:00:00").cast("timestamp_ntz")).alias("l_shipdate")),
    }
    for t, df in made.items():
        df.write.parquet(f"{sf}/{t}.parquet")
    return sf


@pytest.fixture
def shuffled(spark):
    """Joins are shuffled and keep all their partitions."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    yield
    for c, v in before.items():
        spark.conf.set(c, v)


def test_landing_moves_line_items_twice_and_sorts_them_narrow(spark, tables, shuffled):
    """By order and by part, not a third time by month; text is made of sorted rows."""
    plan = q_ingest.listing_text(spark, tables)._jdf.queryExecution().executedPlan().toString().splitlines()
    moves = [line.strip(" :+-") for line in plan if "Exchange" in line]
    assert not any("rangepartitioning" in m for m in moves)
    assert len([m for m in moves if "l_partkey" in m]) == 2  # line items and parts, each once
    sort, text = (next(i for i, line in enumerate(plan) if mark in line) for mark in ("Sort [_month", "dd/MM/yyyy"))
    assert text < sort and "dd/MM/yyyy" not in "".join(plan[sort:])


@pytest.mark.parametrize("few_files", [False, True])
def test_landed_files_hold_all_copies_of_a_key_in_load_order(spark, tables, shuffled, few_files):
    land = q_ingest.landing(spark, tables, few_files)
    names = q_ingest.files.month_files_sorted(q_ingest.files.list_files(spark, land))
    rows = q_ingest.ingest.read_csv_text(spark, [f"{land}/{n}" for n in names], schemas.LISTING_COLUMNS).collect()
    assert len(rows) == 400 + 57  # line 4 comes twice
    of_key, of_file = {}, {}
    for r in rows:
        of_key.setdefault((r.listing_id, r._date), set()).add(r._file)
        of_file.setdefault(r._file, []).append(r)
    assert len(of_key) > 10 and all(len(at) == 1 for at in of_key.values())
    for name, own in of_file.items():
        own.sort(key=lambda r: (r._block, r._row))
        order = [(int(r.l_orderkey), int(r.l_linenumber), int(r.l_suppkey), float(r.l_extendedprice), int(r._junk)) for r in own]
        assert order == sorted(order) and {r._date[:7] for r in own} == {f"{name[-8:-4]}-{name[-11:-9]}"}
    # orders come with four priorities in turn
    assert {(int(r.l_orderkey) % 4, r.host_is_superhost) for r in rows} == {(0, "t"), (1, "NaN"), (2, "f"), (3, "f")}
    assert {(r.host_since, r.l_linenumber == "1") for r in rows} == {("01/01/2019", False), (None, True)}
    assert tuple(q_ingest.q_load_quality(spark, tables).first()) == (457, 57, 400)


def shuffle_files(spark):
    """Shuffle files on the disk, once those that were given up are gone."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = blocks.getAllFiles()
    return {n for n in (names.apply(i).getName() for i in range(names.size())) if n.startswith("shuffle_") and n.endswith(".data")}


# each writes what it works on before its result is read
STEPS = ["select_files", "insert_ignore", "stream_monthly_ingest", "mart_listing_neighbourhood", "mart_host_neighbourhood",
         "scd2_double_asof"]


@pytest.mark.parametrize("key", STEPS)
def test_steps_leave_no_shuffle_files(spark, tables, key):
    before = shuffle_files(spark)
    result = QUERIES[key](spark, SF if key == "insert_ignore" else tables)  # loads drops of before 1998
    for _ in range(20):  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left and result.columns


def test_a_step_has_partitions_for_its_bytes_and_gives_settings_back(spark):
    from lodgelake.session import STEP_BYTES, own_step

    initial, freed = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(c, None) for c in (initial, freed)]
    for size, partitions in ((0, before[0]), (STEP_BYTES, before[0]), (100 * STEP_BYTES + 1, "101")):
        with pytest.raises(KeyError), own_step(spark, size):
            assert spark.conf.get(initial, None) == partitions and spark.conf.get(freed) == "true"
            raise KeyError
        assert [spark.conf.get(c, None) for c in (initial, freed)] == before


def _batch(spark, rows):
    """Typed listings (id, date, host name) in load order."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "listing_id bigint, scraped_date string, host_name string, _row bigint")
    cols = {"listing_id": F.col("listing_id"), "scraped_date": F.to_date("scraped_date"), "host_name": F.col("host_name")}
    return made.select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.AIRBNB_RAW.fields],
                       F.lit("a.csv").alias("_file"), F.lit(0).cast("bigint").alias("_block"), "_row")


@pytest.mark.parametrize("most", [1, 3, 100])
def test_months_merged_apart_make_the_table_of_one_merge(spark, monkeypatch, most):
    from lodgelake.session import scratch_path

    ingest = q_ingest.ingest
    monkeypatch.setattr(ingest, "ROWS_AT_ONCE", most)
    table, got = scratch_path(spark, "bronze"), []
    first = [(1, "2020-01-05", "a"), (1, "2020-01-05", "b"), (2, "2020-03-01", "c"), (None, "2020-03-01", "d")]
    again = [(1, "2020-01-05", "x"), (1, "2020-01-06", "e"), (3, None, "f"), (3, None, "g"), (None, "2020-03-01", "h"),
             (4, "2020-04-01", "i"), (4, "2020-04-01", "y"), (2, "2020-03-01", "z")]
    for rows in (first, again, []):
        new = ingest.append_insert_ignore(spark, table, _batch(spark, rows), scratch_path(spark, "staged"))
        assert new.columns == schemas.LISTING_COLUMNS
        got.append("".join(sorted(r.host_name for r in new.collect())))
    assert got == ["acd", "efghi", ""]
    assert "".join(sorted(r.host_name for r in ingest.read_bronze(spark, table).collect())) == "acdefghi"
    assert ingest.months_at_once({"b": 2, "a": 1, "d": 9, "c": 1}, 3) == [["a", "b"], ["c"], ["d"]] if most == 3 else True


def test_insert_ignore_moves_its_batch_once(spark, shuffled):
    """The pick and the anti-join take the rows in one place."""
    batch = _batch(spark, [(1, "2020-01-05", "a"), (2, "2020-01-05", "b")])
    plan = q_ingest.ingest.insert_ignore(batch.where("host_name = 'a'"), batch)._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "Exchange hashpartitioning(listing_id" in line]) == 2
