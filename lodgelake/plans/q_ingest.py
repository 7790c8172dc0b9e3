"""Registered queries for ingestion (survey section 2.1): CSV month drops,
file selection, header handling, insert-ignore appends, full refresh, the
ledger of loaded files and the monthly incremental run.

The landing zone is generated from the mapped driver tables by Spark (one
writer job per session and scale, files are immutable afterwards) inside the
shared checkpoint folder.  Every listing row is written; rows on line 4 are
written a second time with an impossible date (31 February) so that the
quality guard has something to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake import schemas
from lodgelake.plans import marts
from lodgelake.plans.catalog import register
from lodgelake.plans.layers import Layers
from lodgelake.plans.oracle_sql import with_base
from lodgelake.plans.oracle_analysis import HOST_MART
from lodgelake.plans.versions import VersionedTables
from lodgelake.session import own_step, scratch_path
from lodgelake.sources import files, ingest, testdata

# --- fixed values: names of the census and mapping drops ---
CENSUS_FILES = {
    "census_g01": "2016Census_G01_NSW_LGA.csv",
    "census_g02": "2016Census_G02_NSW_LGA.csv",
    "nsw_lga_suburb": "NSW_LGA_SUBURB.csv",
    "nsw_lga_code": "NSW_LGA_CODE.csv",
}
EXTRA = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
_LANDINGS: dict[tuple[str, str, bool], str] = {}
_CENSUS_LANDINGS: dict[tuple[str, str], str] = {}


def _mixed_case(name: str) -> str:
    """Header as census files spell it: code columns upper, others Title_Case,
    padded with blanks."""
    if name.startswith("lga_"):
        return f" {name.upper()} "
    return " " + "_".join(p[:1].upper() + p[1:] for p in name.split("_")) + " "


def listing_text(spark: SparkSession, sf: str, month: Column | None = None, few_files: bool = False) -> DataFrame:
    """Mapped listing rows as the source system writes them (all text), in the
    order of the files; ``month`` is a condition on their date (_date).

    All rows of a listing are where its part was joined, so a month has a file
    of each partition.  ``few_files`` moves them once more, by month and listing.
    """
    joined = testdata.joined_rows(spark, sf, by_part=not few_files).withColumn("_date", F.col("shipped"))
    if month is not None:
        joined = joined.where(month)
    if few_files:
        joined = files.by_month_and_key(joined, F.col("_date"), "l_partkey")
    # line-4 rows are emitted twice (copy 1 is junk)
    copies = F.when(F.col("l_linenumber") == 4, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    narrow = testdata.with_areas(spark, sf, joined).withColumn("_junk", F.explode(copies))
    rows = testdata.as_listings(files.in_file_order(narrow, F.col("_date"), EXTRA + ["_junk"]),
                                keep=["_junk", "_date", "_month"])
    d = F.col("scraped_date")
    text = {
        "scraped_date": F.when(F.col("_junk") == 1, F.concat(F.lit("31/02/"), F.year(d).cast("string")))
                         .otherwise(ingest.day_first_text(d)),
        "host_since": ingest.day_first_text(F.col("host_since")),
        "host_is_superhost": F.coalesce(F.col("host_is_superhost"), F.lit("NaN")),
    }
    cols = [(text[c] if c in text else F.col(c)).cast("string").alias(c) for c in schemas.LISTING_COLUMNS]
    return rows.select(*cols, *EXTRA, "_junk", "_date", "_month")


def landing(spark: SparkSession, sf: str, few_files: bool = False) -> str:
    """Folder with the listing month drops and the census/mapping drops."""
    key = (spark.sparkContext.applicationId, sf, few_files)
    if key in _LANDINGS:
        return _LANDINGS[key]
    land = scratch_path(spark, "landing")
    even = F.month("_date") % 2 == 0
    for month, columns, prefix in ((~even, schemas.LISTING_COLUMNS, "listings"),
                                   (even, schemas.LISTING_COLUMNS[::-1], "reversed")):  # two column orders
        land_months(spark, sf, land, month, columns, prefix, few_files, steps=2 if few_files else 1)
    _land_census(spark, sf, land)
    _LANDINGS[key] = land
    return land


def land_months(spark: SparkSession, sf: str, land: str, month: Column, columns: list[str] = schemas.LISTING_COLUMNS,
                prefix: str = "listings", few_files: bool = False, steps: int = 1) -> None:
    """Land the months that ``month`` is true for, by calendar quarter in 1, 2 or 4
    ``steps``: what one shuffles is gone before the next begins."""
    for k in range(steps):
        own = month & (F.quarter("_date") % steps == k)
        rows = listing_text(spark, sf, own, few_files).select(*columns, *EXTRA, "_junk", "_date", "_month")
        with own_step(spark, testdata.line_bytes(spark, sf)):
            files.write_month_files(spark, rows, land, scratch_path(spark, "staging"), prefix)


def _land_census(spark: SparkSession, sf: str, land: str) -> str:
    """Write the census and mapping drops, made of customers and areas only."""
    bronze = testdata.bronze_tables(spark, sf)
    for kind, name in CENSUS_FILES.items():
        df = bronze[kind]
        df = df.select(*[F.col(c).alias(_mixed_case(c)) for c in df.columns])
        with own_step(spark):
            files.write_named_csv(spark, df, land, scratch_path(spark, "staging"), name)
    return land


def census_landing(spark: SparkSession, sf: str) -> str:
    """Folder of the census and mapping drops, for queries that load nothing else."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CENSUS_LANDINGS:
        _CENSUS_LANDINGS[key] = _land_census(spark, sf, scratch_path(spark, "census-landing"))
    return _CENSUS_LANDINGS[key]


def _paths(spark, land, names):
    return [f"{land.rstrip('/')}/{n}" for n in names]


def _listing_paths(spark, sf, year: int | None = None):
    land = landing(spark, sf)
    names = files.month_files_sorted(files.select_files(files.list_files(spark, land)))
    if year is not None:
        names = [n for n in names if files.month_of_name(n)[0] == year]
    return _paths(spark, land, names)


def _census(spark, sf, kind, make=census_landing):
    land = make(spark, sf)
    names = files.select_files(files.list_files(spark, land), kind)
    return ingest.read_census(spark, _paths(spark, land, names), kind)


# -- oracle fragments -------------------------------------------------------

_LOADED = """
loaded_rows AS (
  SELECT listing_id, scrape_id, scraped_date, host_id,
    coalesce(host_name, 'Unknown') AS host_name,
    coalesce(host_since, DATE '2000-01-01') AS host_since,
    coalesce(host_is_superhost, 'No') AS host_is_superhost,
    coalesce(host_neighbourhood, 'Not specified') AS host_neighbourhood,
    listing_neighbourhood, property_type, room_type, accommodates, price, has_availability,
    availability_30, number_of_reviews, """ + ", ".join(
    f"CAST(coalesce({c}, 0) AS DECIMAL(5,2)) AS {c}" for c in schemas.REVIEW_SCORE_COLUMNS) + """, load_rank
  FROM ranked_load
),
loaded_raw AS (SELECT * EXCLUDE (load_rank) FROM loaded_rows WHERE load_rank = 1)"""

_TEXT_ROWS = """
text_rows AS (
  SELECT CAST(listing_id AS VARCHAR) AS listing_id, CAST(NULL AS VARCHAR) AS scrape_id,
    CASE WHEN junk = 1 THEN '31/02/' || CAST(year(scraped_date) AS VARCHAR)
         ELSE strftime(scraped_date, '%d/%m/%Y') END AS scraped_date,
    CAST(host_id AS VARCHAR) AS host_id, host_name,
    strftime(host_since, '%d/%m/%Y') AS host_since,
    coalesce(host_is_superhost, 'NaN') AS host_is_superhost,
    host_neighbourhood, listing_neighbourhood, property_type, room_type,
    CAST(accommodates AS VARCHAR) AS accommodates, price, has_availability,
    CAST(availability_30 AS VARCHAR) AS availability_30,
    CAST(number_of_reviews AS VARCHAR) AS number_of_reviews,
    CAST(review_scores_rating AS VARCHAR) AS review_scores_rating,
    """ + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in schemas.REVIEW_SCORE_COLUMNS[1:]) + """,
    scraped_date AS true_date, junk
  FROM (SELECT *, 0 AS junk FROM mapped
        UNION ALL SELECT *, 1 AS junk FROM mapped WHERE number_of_reviews = 4) m
)"""

_LISTING_COLS = ", ".join(schemas.LISTING_COLUMNS)


# names a landing folder may hold beside the tables' own; only some are taken
LANDED_NAMES = ["Census_G01_NSW.CSV", "census_g01.csv", "2016Census_G02.Csv", "G01_and_G02.csv", "G02.csv.gz", "G02.txt",
                "LGA_SUBURB.csv", "LGA_CODE.csv", "lga_code.csv", "notes_G01.csv.bak", "csv", "05_2020.csv.part"]


# -- queries ----------------------------------------------------------------

@register("scan_csv", with_base(f"SELECT {_LISTING_COLS} FROM text_rows", _TEXT_ROWS.strip()))
def q_scan_csv(spark, sf):
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS)
    return ingest.project(text, schemas.LISTING_COLUMNS)


@register("normalise_headers", with_base("SELECT * FROM census_g01"))
def q_normalise_headers(spark, sf):
    return _census(spark, sf, "census_g01")


@register("select_files", with_base("SELECT * FROM census_g02"))
def q_select_files(spark, sf):
    """Selected among all that lands, the month drops too."""
    return _census(spark, sf, "census_g02", landing)


@register("file_kinds", """
SELECT name, kind FROM (VALUES ('Census_G01_NSW.CSV', 'census_g01'), ('2016Census_G02.Csv', 'census_g02'),
  ('G01_and_G02.csv', 'census_g01'), ('G01_and_G02.csv', 'census_g02'), ('LGA_SUBURB.csv', 'nsw_lga_suburb'),
  ('LGA_CODE.csv', 'nsw_lga_code')) AS picked(name, kind)
UNION ALL
SELECT 'area_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '_G02.csv', 'census_g02' FROM nation
UNION ALL
SELECT DISTINCT strftime(l_shipdate, 'drop_%m_%Y.CSV'), 'month' FROM lineitem""")
def q_file_kinds(spark, sf):
    """Which of the landed names each kind takes: the suffix in any case, the
    marker in its own case only; names from the tables lie among them."""
    nations, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("nation", "lineitem"))
    landed = (
        spark.createDataFrame([(n,) for n in LANDED_NAMES], "name string")
        .union(nations.select(F.concat(F.lit("area_"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("_G02.csv"))))
        .union(items.select(F.date_format("l_shipdate", "'drop_'MM_yyyy'.CSV'")).distinct())
    )
    return files.kinds_of(landed)


@register("concat_files", with_base(
    f"SELECT {_LISTING_COLS} FROM loaded_rows", _LOADED.strip()))
def q_concat_files(spark, sf):
    # all month drops, read as one relation
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS)
    typed = ingest.type_listings(text)
    return typed.where(F.col("scraped_date").isNotNull()).select(*schemas.LISTING_COLUMNS)


@register("load_projection", with_base(f"SELECT {_LISTING_COLS} FROM loaded_rows", _LOADED.strip()))
def q_load_projection(spark, sf):
    """Every declared column, in the declared order, typed, from files of two
    column orders; a declared column that a file lacks is an error."""
    paths = _listing_paths(spark, sf)
    typed = ingest.type_listings(ingest.read_csv_text(spark, paths, schemas.LISTING_COLUMNS))
    _refuses_missing(spark, paths[:1], schemas.LISTING_COLUMNS)
    return typed.where(F.col("scraped_date").isNotNull()).select(*schemas.LISTING_COLUMNS)


@register("load_some_columns", with_base("""
SELECT listing_id, scraped_date, host_id, price FROM text_rows""", _TEXT_ROWS.strip()))
def q_load_some_columns(spark, sf):
    """A declared list of columns, in its order, from files that have many more;
    a declared column that a file lacks is an error."""
    paths, wanted = _listing_paths(spark, sf), ["listing_id", "scraped_date", "host_id", "price"]
    text = ingest.read_csv_text(spark, paths, wanted)
    _refuses_missing(spark, paths[:1], wanted)
    return ingest.project(text, wanted)


def _refuses_missing(spark, paths, wanted) -> None:
    try:
        ingest.read_csv_text(spark, paths, [*wanted, "no_such_column"])
    except ValueError:
        return
    raise AssertionError("a missing declared column was accepted")


@register("null_normalise", with_base(
    "SELECT listing_id, scraped_date, nullif(host_is_superhost, 'NaN') AS host_is_superhost, "
    "host_since, availability_30 FROM text_rows", _TEXT_ROWS.strip()))
def q_null_normalise(spark, sf):
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS)
    cols = ["listing_id", "scraped_date", "host_is_superhost", "host_since", "availability_30"]
    return ingest.null_tokens(text.select(*cols))


@register("month_from_filename", with_base(
    "SELECT CAST(year(true_date) AS INTEGER) AS yyyy, CAST(month(true_date) AS INTEGER) AS mm, "
    "count(*) AS n_rows FROM text_rows GROUP BY 1, 2 ORDER BY 1, 2", _TEXT_ROWS.strip()))
def q_month_from_filename(spark, sf):
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS)
    f = F.col("_file")
    return (text.select(files.file_year(f).alias("yyyy"), files.file_month(f).alias("mm"))
            .where(F.col("mm").isNotNull())
            .groupBy("yyyy", "mm").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("yyyy", "mm"))


@register("load_quality", with_base("""
SELECT count(*) AS rows_read, CAST(count_if(junk = 1) AS BIGINT) AS rows_dropped,
  CAST(count_if(junk = 0) AS BIGINT) AS rows_kept
FROM text_rows""", _TEXT_ROWS.strip()))
def q_load_quality(spark, sf):
    """Counted by the load itself: the valid rows are written, once, and the
    metrics of that write are the result."""
    typed = ingest.type_listings(ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS))
    good, seen = ingest.quality_split(typed)
    good.select(*schemas.LISTING_COLUMNS).write.parquet(scratch_path(spark, "loaded"), compression="zstd")
    return ingest.quality_summary(spark, seen)


@register("file_ledger", with_base("""
SELECT CAST(year(true_date) AS INTEGER) AS yyyy, CAST(month(true_date) AS INTEGER) AS mm,
  count(*) AS rows_read, CAST(count_if(junk = 0) AS BIGINT) AS rows_valid
FROM text_rows GROUP BY 1, 2""", _TEXT_ROWS.strip()))
def q_file_ledger(spark, sf):
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS)
    typed = ingest.type_listings(text)
    ledger = scratch_path(spark, "ledger")
    with own_step(spark):
        ingest.record_files(ledger, ingest.ledger_rows(typed))
    led = spark.read.parquet(ledger)
    return led.groupBy("yyyy", "mm").agg(F.sum("rows_read").alias("rows_read"),
                                         F.sum("rows_valid").alias("rows_valid"))


@register("unique_violations", with_base("""
SELECT listing_id, scraped_date, count(*) AS copies FROM loaded_rows
GROUP BY 1, 2 HAVING count(*) > 1""", _LOADED.strip()))
def q_unique_violations(spark, sf):
    typed = ingest.type_listings(ingest.read_csv_text(spark, _listing_paths(spark, sf), schemas.LISTING_COLUMNS))
    keyed = typed.where(F.col("listing_id").isNotNull() & F.col("scraped_date").isNotNull())
    return (keyed.groupBy("listing_id", "scraped_date").agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


@register("insert_ignore", with_base(f"SELECT {_LISTING_COLS} FROM loaded_raw", _LOADED.strip()))
def q_insert_ignore(spark, sf):
    """Load the drops before 1998, then replay every drop: the table ends with
    one row per key, the first in load order, exactly as a single load would."""
    bronze = scratch_path(spark, "bronze")
    for year_filter in (lambda y: y < 1998, lambda y: True):
        paths = [p for p in _listing_paths(spark, sf)
                 if year_filter(files.month_of_name(p.rsplit("/", 1)[1])[0])]
        typed = ingest.type_listings(ingest.read_csv_text(spark, paths, schemas.LISTING_COLUMNS))
        good, _ = ingest.quality_split(typed)
        with ingest.staged(spark, good) as rows, ingest.scratch(spark) as new:
            ingest.append_insert_ignore(spark, bronze, rows, new)
    return ingest.read_bronze(spark, bronze)


@register("next_month_load", with_base(
    f"SELECT {_LISTING_COLS} FROM loaded_raw WHERE scraped_date >= DATE '1996-01-01' "
    "AND scraped_date < DATE '1996-02-01'", _LOADED.strip()))
def q_next_month_load(spark, sf):
    """The 1995 drops are already in the ledger; one monthly run loads the next
    month in calendar order (January 1996) and nothing else."""
    land = landing(spark, sf)
    bronze, ledger = scratch_path(spark, "bronze"), scratch_path(spark, "ledger")
    text = ingest.read_csv_text(spark, _listing_paths(spark, sf, year=1995), schemas.LISTING_COLUMNS)
    with ingest.staged(spark, ingest.type_listings(text, month_locked=True)) as typed, ingest.scratch(spark) as new:
        ingest.append_insert_ignore(spark, bronze, typed.where(F.col("scraped_date").isNotNull()), new)
        ingest.record_files(ledger, ingest.ledger_rows(typed))
    return ingest.load_next_month(spark, land, bronze, ledger, scratch_path(spark, "staged"))


@register("full_refresh", with_base("SELECT * FROM census_g02"))
def q_full_refresh(spark, sf):
    table = scratch_path(spark, "census_g02")
    ingest.full_refresh(table, _census(spark, sf, "census_g01").where(F.lit(False)))  # empty: skipped
    ingest.full_refresh(table, _census(spark, sf, "census_g02"))
    ingest.full_refresh(table, _census(spark, sf, "census_g02").where(F.lit(False)))  # stays
    return spark.read.parquet(table)


@register("load_defaults", with_base(f"SELECT {_LISTING_COLS} FROM loaded_raw", _LOADED.strip()))
def q_load_defaults(spark, sf):
    return ingest.apply_load_defaults(Layers(spark, sf).bronze["airbnb_raw"])


@register("bronze_passthrough", with_base("SELECT * FROM airbnb_raw"))
def q_bronze_passthrough(spark, sf):
    return Layers(spark, sf).bronze["airbnb_raw"].select("*")


@register("materialise_table", with_base("SELECT * FROM airbnb_cleaned"))
def q_materialise_table(spark, sf):
    """Written under a version folder and committed; read as a later run does."""
    base = scratch_path(spark, "silver")
    tables = VersionedTables(spark, base)
    tables.put("listings", Layers(spark, sf).listings)
    tables.commit()
    return VersionedTables(spark, base).read("listings")


@register("materialise_view", HOST_MART)
def q_materialise_view(spark, sf):
    L = Layers(spark, sf).written()
    marts.mart_host_neighbourhood(L.fact, L.host_history, L.lga_suburb, L.step) \
        .createOrReplaceTempView("dm_host_neighbourhood")
    return spark.table("dm_host_neighbourhood")
