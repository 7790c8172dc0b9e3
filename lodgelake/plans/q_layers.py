"""Registered queries for the layered models: silver, history, star, marts and
analyses (survey sections 2.9 - 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgelake.operators import scd2
from lodgelake.plans import analysis, marts, oracle_analysis, star
from lodgelake.plans.catalog import register
from lodgelake.plans.layers import Layers, open_versions, put_history
from lodgelake.plans.oracle_sql import HOST_ATTRS, PROP_ATTRS, asof, with_base
from lodgelake.plans.versions import VersionedTables
from lodgelake.session import own_step, scratch_path

# ---------------------------------------------------------------- silver ----


@register("silver_listings", with_base("SELECT * FROM airbnb_cleaned"))
def q_silver_listings(spark, sf):
    return Layers(spark, sf).listings


@register("silver_census_g01", with_base("SELECT * FROM census_g01_cleaned"))
def q_silver_census_g01(spark, sf):
    return Layers(spark, sf).census_g01


@register("silver_census_g02", with_base("SELECT * FROM census_g02_cleaned"))
def q_silver_census_g02(spark, sf):
    return Layers(spark, sf).census_g02


@register("silver_lga_code", with_base("SELECT * FROM lga_code_cleaned"))
def q_silver_lga_code(spark, sf):
    return Layers(spark, sf).lga_code


@register("silver_lga_suburb", with_base("SELECT * FROM lga_suburb_cleaned"))
def q_silver_lga_suburb(spark, sf):
    return Layers(spark, sf).lga_suburb


@register("silver_dim_host", with_base("SELECT * FROM dim_host"))
def q_silver_dim_host(spark, sf):
    return Layers(spark, sf, columns=star.HOST_ROWS).dim_host_silver


@register("silver_dim_property", with_base("SELECT * FROM dim_property"))
def q_silver_dim_property(spark, sf):
    return Layers(spark, sf, columns=[*star.PROPERTY_ROWS, "price"]).dim_property_silver


# --------------------------------------------------------------- history ----

_HIST_COLS = "valid_from, valid_to, updated_at, scraped_date"


HISTORY_SQL = with_base(f"SELECT host_id, {', '.join(HOST_ATTRS)}, {_HIST_COLS} FROM host_snapshot")


def _open(spark, sf, name, columns):
    """Open versions of a history written with open and closed versions apart:
    one partition is read, however long the closed history is."""
    t = VersionedTables(spark, scratch_path(spark, "history"))
    return open_versions(put_history(t, name, getattr(Layers(spark, sf, columns=columns), name)))


@register("scd2_host_history", HISTORY_SQL)
def q_scd2_host_history(spark, sf):
    return Layers(spark, sf, columns=star.HOST_ROWS).host_history


@register("scd2_property_history", with_base(
    f"SELECT listing_id, {', '.join(PROP_ATTRS)}, {_HIST_COLS} FROM property_snapshot"))
def q_scd2_property_history(spark, sf):
    return Layers(spark, sf, columns=star.PROPERTY_ROWS).property_history


@register("scd2_current", with_base(
    f"SELECT host_id, {', '.join(HOST_ATTRS)}, {_HIST_COLS} FROM host_snapshot "
    "WHERE valid_to IS NULL"))
def q_scd2_current(spark, sf):
    return _open(spark, sf, "host_history", star.HOST_ROWS)


# Incremental runs: history of the rows before the cut, then the whole table
# applied as one batch; in date order this equals the full rebuild.
_CUT = "1998-01-01"


def _host_rows_written(spark, sf):
    """The distinct host rows, written once: histories read them several times."""
    path = scratch_path(spark, "bronze-listings-of-hosts")
    star.with_updated_at(Layers(spark, sf, columns=star.HOST_ROWS).dim_host_silver).write.parquet(path)
    return spark.read.parquet(path)


@register("scd2_apply", with_base(
    f"SELECT host_id, {', '.join(HOST_ATTRS)}, {_HIST_COLS} FROM host_snapshot"))
def q_scd2_apply(spark, sf):
    src = _host_rows_written(spark, sf)
    before = scd2.build_history(src.where(F.col("scraped_date") < F.lit(_CUT).cast("date")),
                                "host_id", star.HOST_ATTRS)
    return scd2.apply_batch(before, src, "host_id", star.HOST_ATTRS,
                            invalidate_hard_deletes=True)


# Hard deletes: the history of the rows before the cut receives only the later
# rows; hosts without any later scrape are closed at the batch's latest time.
_DEL_CUT = "1999-01-01"

_HARD_DELETE_SQL = with_base(f"""
SELECT host_id, {', '.join(HOST_ATTRS)}, valid_from,
  CASE WHEN valid_to IS NULL AND host_id NOT IN (SELECT host_id FROM later)
       THEN (SELECT max(updated_at) FROM later) ELSE valid_to END AS valid_to,
  updated_at, scraped_date
FROM host_snapshot""", """
later AS (
  SELECT host_id, CAST(scraped_date AS TIMESTAMP) AS updated_at FROM dim_host
  WHERE scraped_date >= DATE '1999-01-01'
)""")


@register("scd2_hard_delete", _HARD_DELETE_SQL)
def q_scd2_hard_delete(spark, sf):
    src = _host_rows_written(spark, sf)
    cut = F.lit(_DEL_CUT).cast("date")
    before = scd2.build_history(src.where(F.col("scraped_date") < cut), "host_id", star.HOST_ATTRS)
    return scd2.apply_batch(before, src.where(F.col("scraped_date") >= cut), "host_id",
                            star.HOST_ATTRS, invalidate_hard_deletes=True)


@register("scd2_asof_join", with_base("""
SELECT f.listing_id, f.scraped_date, f.host_id, a.listing_neighbourhood, a.property_type
FROM fact_listings f """ + asof("a", "property_snapshot", "listing_id")))
def q_scd2_asof_join(spark, sf):
    L = Layers(spark, sf).written()
    facts = L.fact.select("listing_id", "scraped_date", "host_id")
    return scd2.asof_join(facts, L.property_history, "listing_id", "scraped_date",
                          ["listing_neighbourhood", "property_type"], bounded_per_key=True, bucket="year")


# History built only from rows on or after 1996-01-01: earlier facts find no
# version and keep NULL attributes (left join).
@register("scd2_asof_unmatched", with_base("""
SELECT f.listing_id, f.scraped_date, f.host_id, h.host_neighbourhood, h.host_is_superhost
FROM fact_listings f """ + asof("h", "late_snapshot", "host_id"), """
late_one AS (
  SELECT host_id, host_neighbourhood, host_is_superhost, CAST(scraped_date AS TIMESTAMP) AS ts,
    row_number() OVER (PARTITION BY host_id, scraped_date ORDER BY host_name DESC NULLS LAST,
      host_since DESC NULLS LAST, host_is_superhost DESC NULLS LAST,
      host_neighbourhood DESC NULLS LAST) AS version_rank
  FROM dim_host WHERE scraped_date >= DATE '1996-01-01'
),
late_snapshot AS (
  SELECT host_id, host_neighbourhood, host_is_superhost, ts AS valid_from,
    lead(ts) OVER (PARTITION BY host_id ORDER BY ts) AS valid_to
  FROM late_one WHERE version_rank = 1
)"""))
def q_scd2_asof_unmatched(spark, sf):
    L = Layers(spark, sf).written()
    src = star.with_updated_at(L.dim_host_silver).where(
        F.col("scraped_date") >= F.lit("1996-01-01").cast("date"))
    hist = scd2.build_history(src, "host_id", star.HOST_ATTRS)
    facts = L.fact.select("listing_id", "scraped_date", "host_id")
    return scd2.asof_join(facts, hist, "host_id", "scraped_date",
                          ["host_neighbourhood", "host_is_superhost"])


# ------------------------------------------------------------------ star ----


@register("gold_fact_listings", with_base("SELECT * FROM fact_listings"))
def q_gold_fact_listings(spark, sf):
    return Layers(spark, sf).fact


@register("gold_dim_host", with_base(
    f"SELECT host_id, {', '.join(HOST_ATTRS)} FROM host_snapshot WHERE valid_to IS NULL"))
def q_gold_dim_host(spark, sf):
    return star.dim_host_current(_open(spark, sf, "host_history", star.HOST_ROWS))


@register("gold_dim_listing", with_base(
    f"SELECT listing_id, {', '.join(PROP_ATTRS)} FROM property_snapshot WHERE valid_to IS NULL"))
def q_gold_dim_listing(spark, sf):
    return star.dim_listing(_open(spark, sf, "property_history", star.PROPERTY_ROWS))


@register("gold_dim_suburb", with_base("SELECT suburb_name, lga_name FROM lga_suburb_cleaned"))
def q_gold_dim_suburb(spark, sf):
    return star.dim_suburb(Layers(spark, sf).lga_suburb)


@register("gold_dim_lga", with_base("SELECT lga_code, lga_name FROM lga_code_cleaned"))
def q_gold_dim_lga(spark, sf):
    return star.dim_lga(Layers(spark, sf).lga_code)


# ----------------------------------------------------------------- marts ----

@register("mart_listing_neighbourhood", oracle_analysis.LISTING_MART)
def q_mart_listing_neighbourhood(spark, sf):
    L = Layers(spark, sf).written()
    return marts.mart_listing_neighbourhood(L.fact, L.property_history, L.host_history, L.step)


# The mart's ingredients are kept by month; the last month comes in by itself.
@register("mart_month_update", oracle_analysis.LISTING_MART)
def q_mart_month_update(spark, sf):
    L = Layers(spark, sf).written()
    t = VersionedTables(spark, scratch_path(spark, "mart-months"))
    latest = marts.monthly_fact(L.fact, L.property_history, L.host_history, L.step)
    with own_step(spark, L.step_bytes):
        facts = t.put("fact_month", latest, "month_start")
    newest = facts.agg(F.max("month_start")).first()[0]
    earlier = facts.where(F.col("month_start") < newest)  # all there is before the last month
    with own_step(spark, L.step_bytes):
        t.put("neighbourhood_month", marts.neighbourhood_parts(earlier), "month_start")
    t.commit()
    t = VersionedTables(spark, t.base)
    month = t.read("fact_month").where(F.col("month_start") == newest)
    with own_step(spark, L.step_bytes):
        t.put("neighbourhood_month", marts.neighbourhood_parts(month), "month_start", lambda m: m != str(newest))
    t.commit()
    return marts.neighbourhood_from_parts(t.read("neighbourhood_month"))


@register("mart_property_type", oracle_analysis.PROPERTY_MART)
def q_mart_property_type(spark, sf):
    L = Layers(spark, sf).written()
    return marts.mart_property_type(L.fact, L.property_history, L.host_history, L.step)


@register("mart_host_neighbourhood", oracle_analysis.HOST_MART)
def q_mart_host_neighbourhood(spark, sf):
    L = Layers(spark, sf).written()
    return marts.mart_host_neighbourhood(L.fact, L.host_history, L.lga_suburb, L.step)


# -------------------------------------------------------------- analyses ----

@register("top_bottom_demographics", oracle_analysis.TOP_BOTTOM)
def q_top_bottom_demographics(spark, sf):
    L = Layers(spark, sf)
    return analysis.top_bottom_demographics(L.listings, L.lga_suburb, L.lga_code,
                                            L.census_g01, L.census_g02)


@register("age_vs_revenue", oracle_analysis.AGE_REVENUE)
def q_age_vs_revenue(spark, sf):
    L = Layers(spark, sf)
    return analysis.age_vs_revenue(L.listings, L.lga_suburb, L.lga_code, L.census_g02)


@register("age_revenue_corr", oracle_analysis.AGE_CORRELATION)
def q_age_revenue_corr(spark, sf):
    L = Layers(spark, sf)
    out = analysis.age_revenue_corr(L.listings, L.lga_suburb, L.lga_code, L.census_g02)
    r = F.col("corr_age_revenue")  # nine digits: sums of doubles depend on their order
    return out.select("n_pairs", (F.signum(r) * F.floor(F.abs(r) * 1e9 + 0.5) / 1e9).alias("corr_age_revenue"))


@register("best_listing_type", oracle_analysis.BEST_KIND)
def q_best_listing_type(spark, sf):
    return analysis.best_listing_type(Layers(spark, sf).listings)


@register("host_concentration", oracle_analysis.CONCENTRATION)
def q_host_concentration(spark, sf):
    L = Layers(spark, sf)
    return analysis.host_concentration(L.listings, L.lga_suburb, L.lga_code)


@register("mortgage_coverage", oracle_analysis.MORTGAGE)
def q_mortgage_coverage(spark, sf):
    L = Layers(spark, sf)
    return analysis.mortgage_coverage(L.listings, L.lga_suburb, L.lga_code, L.census_g02)
