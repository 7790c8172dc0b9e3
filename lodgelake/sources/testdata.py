"""The TPC-H-like driver tables mapped onto the listing and census schemas.

One row of lineitem becomes one listing snapshot:

  listing_id = l_partkey            scraped_date = date(l_shipdate)
  host_id    = o_custkey            host_name    = c_name
  host_since = date(o_orderdate), NULL on line 1 (exercises the default)
  superhost  = 't' for 1-URGENT orders, NULL for 5-LOW, else 'f'
  host / listing neighbourhood = nation of the customer / of the supplier
  untidy cells: host_name with quotes and a comma on line 3 and a line break on
  line 4; listing area NULL or blank on line 5 (by supplier), padded lower case
  on line 6
  property_type = p_type, room_type = 2nd word of p_name, accommodates = p_size % 8 + 1
  price = l_extendedprice as '$1,234.50' text, has_availability = 'f' on returns
  availability_30 = l_quantity (NULL on line 7), number_of_reviews = l_linenumber
  review_scores_rating = l_discount * 1000

Suburb -> LGA is nation -> region; nation 2 has a NULL LGA, nation 3 is not
mapped, nation 5 lies in two LGAs, and one LGA has no code.  The LGA code is 10000 + r_regionkey (the
census tables spell it 'LGA1000x').  Census G01 counts customers per region by
sex (c_custkey % 2) and by eleven balance bands standing in for age bands;
G02 medians are linear in the region key.  Everything grows with the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake import schemas
from lodgelake.operators.dedupe import first_per_key
from lodgelake.sources import files

LISTING_KEY = ["listing_id", "scraped_date"]
# order that decides which of several rows for one key is "first in the file"
LOAD_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the line items, which the size of a mapping step goes by."""
    return files.bytes_of(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


def _price_text(price: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(price, 2))


def _of_load_order() -> dict[str, Column]:
    """Listing columns that are made of the load-order columns or are always NULL."""
    return {
        "scrape_id": F.lit(None).cast("bigint"),
        "price": _price_text(F.col("l_extendedprice").cast("decimal(18,2)")),
        "number_of_reviews": F.col("l_linenumber").cast("int"),
    } | {c: F.lit(None).cast("decimal(5,2)") for c in schemas.REVIEW_SCORE_COLUMNS[1:]}


def joined_rows(spark: SparkSession, sf_dir: str, by_part: bool = False) -> DataFrame:
    """Line items with order, customer, supplier and part: the narrow columns of
    the tables that listing snapshots are made of (``as_listings``).  What is a
    flag or a day is made one before it moves.  ``by_part``: the rows of a part
    are in one partition."""
    prio = F.col("o_orderpriority")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("returned"),
        F.to_date("l_shipdate").alias("shipped"))
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.to_date("o_orderdate").alias("ordered"),
        F.when(prio == "1-URGENT", True).when(prio == "5-LOW", None).otherwise(False).alias("urgent"))
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    supp = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("room_type"),
        (F.col("p_size") % 8 + 1).cast("int").alias("accommodates"))
    # the line items move twice: by order, narrow, then by part, which is also how
    # the pick per listing wants them
    ordered = li.join(supp, "l_suppkey").join(orders.join(cust, "o_custkey"), "l_orderkey")
    return (ordered.repartition("l_partkey") if by_part else ordered).join(part, "l_partkey")


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listing snapshots (bronze shape) plus the load-order columns."""
    return as_listings(with_areas(spark, sf_dir, joined_rows(spark, sf_dir)))


def with_areas(spark: SparkSession, sf_dir: str, joined: DataFrame) -> DataFrame:
    """``joined_rows`` with the names of both areas, in the same partitions."""
    nation = read_table(spark, sf_dir, "nation")
    host_area = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                              F.col("n_name").alias("host_neighbourhood"))
    listing_area = nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                 F.col("n_name").alias("listing_neighbourhood"))
    # nations are few; sent along, they leave the rows where they are
    j = joined.join(F.broadcast(host_area), "c_nationkey").join(F.broadcast(listing_area), "s_nationkey")
    return j.drop("c_nationkey", "s_nationkey")


def as_listings(named: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Listing snapshots of rows ``with_areas``: one projection, which keeps the
    rows' order."""
    line, area, third = F.col("l_linenumber"), F.col("listing_neighbourhood"), F.col("l_suppkey") % 3
    cols = {
        "listing_id": F.col("l_partkey"),
        "scraped_date": F.col("shipped"),
        "host_id": F.col("o_custkey"),
        "host_name": F.when(line == 3, F.concat("c_name", F.lit(' "Jr", x')))
                      .when(line == 4, F.concat("c_name", F.lit("\n2"))).otherwise(F.col("c_name")),
        "host_since": F.when(line != 1, F.col("ordered")),
        "host_is_superhost": F.when(F.col("urgent"), "t").when(~F.col("urgent"), "f"),
        "host_neighbourhood": F.col("host_neighbourhood"),
        "listing_neighbourhood": F.when((line == 5) & (third == 0), None).when((line == 5) & (third == 1), " ")
                                  .when(line == 6, F.concat(F.lit("  "), F.lower(area), F.lit(" "))).otherwise(area),
        "property_type": F.col("p_type"),
        "room_type": F.col("room_type"),
        "accommodates": F.col("accommodates"),
        "has_availability": F.when(F.col("returned"), "f").otherwise("t"),
        "availability_30": F.when(line != 7, F.col("l_quantity").cast("int")),
        "review_scores_rating": (F.col("l_discount") * 1000).cast("decimal(5,2)"),
    }
    cols |= _of_load_order()
    return named.select(*[cols[c].alias(c) for c in schemas.LISTING_COLUMNS], *LOAD_ORDER, *keep)


def bronze_listings(spark: SparkSession, sf_dir: str, columns: Sequence[str] = schemas.LISTING_COLUMNS) -> DataFrame:
    """bronze.airbnb_raw: the first row per (listing_id, scraped_date) wins.

    Of a row the pick holds the columns up to the last one wanted, which decides
    ties as all of them do, less those that the load order fixes: these are made
    after it.
    """
    made = _of_load_order()
    last = max(schemas.LISTING_COLUMNS.index(c) for c in columns)
    picked = [c for c in schemas.LISTING_COLUMNS[:last + 1] if c not in made and c not in LISTING_KEY]
    rows = listing_rows(spark, sf_dir).select(*LISTING_KEY, *picked, *LOAD_ORDER)
    first = first_per_key(rows, LISTING_KEY, LOAD_ORDER)
    return first.select(*[made.get(c, F.col(c)).alias(c) for c in schemas.LISTING_COLUMNS if c in columns])


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return r.select(
        "r_regionkey",
        F.col("r_name").alias("lga_name"),
        (F.col("r_regionkey") + 10000).cast("string").alias("lga_code"),
    )


def bronze_lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    closed = r.where("r_regionkey = 0").select(
        F.lit(None).cast("string").alias("lga_code"), F.concat("lga_name", F.lit(" OLD")).alias("lga_name"))
    return r.select("lga_code", "lga_name").union(closed)


def bronze_lga_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    second = n.where("n_nationkey = 5").withColumn("n_regionkey", (F.col("n_regionkey") + 1) % 5)
    rows = n.where("n_nationkey != 3").union(second)
    return (rows.join(r, rows.n_regionkey == r.r_regionkey)
            .select(F.when(F.col("n_nationkey") != 2, F.col("r_name")).alias("lga_name"),
                    F.col("n_name").alias("suburb_name")))


def bronze_census_g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    k = F.col("r_regionkey")
    vals = {
        "lga_code_2016": F.concat(F.lit("LGA"), F.col("lga_code")),
        "median_age_persons": (k * 3 + 30).cast("int"),
        "median_mortgage_repay_monthly": (k * 15000 + 60000).cast("int"),
        "average_household_size": (F.lit(2.0) + k * 0.2).cast("decimal(6,3)"),
    }
    return r.select(*[
        (vals[f.name] if f.name in vals else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.CENSUS_G02.fields
    ])


def balance_band(acctbal: Column) -> Column:
    """Eleven equal 1000-wide bands of account balance over [-1000, 10000]."""
    return F.least(F.lit(10), F.greatest(F.lit(0), F.floor((acctbal + 1000) / 1000))).cast("int")


def bronze_census_g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(
        "c_nationkey", balance_band(F.col("c_acctbal")).alias("band"),
        (F.col("c_custkey") % 2).alias("sex"))
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    per = cust.join(n, "c_nationkey").join(_regions(spark, sf_dir), "r_regionkey")
    sex_test = {"m": F.col("sex") == 0, "f": F.col("sex") == 1, "p": F.lit(True)}
    aggs = {f"tot_p_{s}": F.count_if(t) for s, t in sex_test.items()}
    for b, (measure, _) in enumerate(schemas.AGE_BANDS):
        for s, t in sex_test.items():
            aggs[f"{measure}_{s}"] = F.count_if((F.col("band") == b) & t)
    counts = per.groupBy("lga_code").agg(*[v.alias(k) for k, v in aggs.items()])
    counts = counts.withColumn("lga_code_2016", F.concat(F.lit("LGA"), F.col("lga_code")))
    return counts.select(*[
        (F.col(f.name) if f.name in aggs or f.name == "lga_code_2016" else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schemas.CENSUS_G01.fields
    ])


def bronze_tables(spark: SparkSession, sf_dir: str, columns: Sequence[str] = schemas.LISTING_COLUMNS) -> dict[str, DataFrame]:
    """All five bronze tables, lazily defined; the listings with these columns."""
    return {
        "airbnb_raw": bronze_listings(spark, sf_dir, columns),
        "census_g01": bronze_census_g01(spark, sf_dir),
        "census_g02": bronze_census_g02(spark, sf_dir),
        "nsw_lga_suburb": bronze_lga_suburb(spark, sf_dir),
        "nsw_lga_code": bronze_lga_code(spark, sf_dir),
    }
