"""Registered queries exercising single operators (survey sections 2.2 - 2.8).

Each reads the mapped driver tables (so its work grows with them) and applies
one operator of the library; the oracle SQL states the same operation in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodgelake.functions import (
    cents, clean_price, digits_only, exact_quotient, format_month, initcap_words, lower_trim,
    minus_months, month_bucket, null_sentinels, parse_date_cascade, parse_date_dayfirst,
    parse_date_month_locked, pct_change_rounded, ratio_half_up, safe_ratio, stays_30,
    stays_30_clamped,
)
from lodgelake.operators import scd2
from lodgelake.operators.dedupe import latest_per_key, top1_window
from lodgelake.operators.keyfilter import without_keys_of
from lodgelake.operators.median import exact_median
from lodgelake.plans import analysis, marts, oracle_analysis
from lodgelake.plans.catalog import register
from lodgelake.plans.layers import Layers
from lodgelake.plans.oracle_sql import (
    asof, cents as sql_cents, digits, initcap, quotient, ratio, stays, stays_clamped, with_base,
)
from lodgelake.schemas import AGE_BANDS, LISTING_COLUMNS

MONTH = "CAST(date_trunc('month', scraped_date) AS DATE)"


def _L(spark, sf, columns=LISTING_COLUMNS):
    return Layers(spark, sf, columns=columns)


# ----------------------------------------------------- projections/filters --

@register("project_fact", with_base(
    "SELECT listing_id, host_id, scraped_date, price AS nightly_price, "
    "number_of_reviews AS reviews FROM fact_listings"))
def q_project_fact(spark, sf):
    f = _L(spark, sf).fact
    return f.select("listing_id", "host_id", "scraped_date", F.col("price").alias("nightly_price"),
                    F.col("number_of_reviews").alias("reviews"))


@register("project_star_plus", with_base(f"""
SELECT f.*, {MONTH} AS month_start,
  CASE WHEN has_availability = 't' THEN 1 ELSE 0 END AS is_active,
  {stays("availability_30")} AS stays_in_30_days
FROM fact_listings f"""))
def q_project_star_plus(spark, sf):
    f = _L(spark, sf).fact
    return f.select("*", month_bucket(F.col("scraped_date")).alias("month_start"),
                    F.when(F.col("has_availability") == "t", 1).otherwise(0).alias("is_active"),
                    stays_30(F.col("availability_30")).alias("stays_in_30_days"))


@register("filter_current", with_base(
    "SELECT listing_id, property_type, room_type, accommodates, listing_neighbourhood, valid_from "
    "FROM property_snapshot WHERE valid_to IS NULL"))
def q_filter_current(spark, sf):
    h = scd2.current(_L(spark, sf).property_history)
    return h.select("listing_id", "property_type", "room_type", "accommodates",
                    "listing_neighbourhood", "valid_from")


@register("filter_not_null", with_base(
    "SELECT listing_id, scraped_date, host_since FROM airbnb_raw WHERE host_since IS NOT NULL"))
def q_filter_not_null(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return raw.where(F.col("host_since").isNotNull()).select("listing_id", "scraped_date", "host_since")


@register("filter_not_blank", with_base(
    "SELECT listing_id, scraped_date, listing_neighbourhood FROM airbnb_cleaned "
    "WHERE listing_neighbourhood IS NOT NULL AND trim(listing_neighbourhood) <> ''"))
def q_filter_not_blank(spark, sf):
    c = _L(spark, sf).listings
    return (c.where(F.col("listing_neighbourhood").isNotNull()
                    & (F.trim(F.col("listing_neighbourhood")) != ""))
            .select("listing_id", "scraped_date", "listing_neighbourhood"))


def _date_text(df):
    """Scrape date as the loaders see it: day-first text, with an impossible
    date (31 February) on every third line number."""
    d = F.col("scraped_date")
    return df.withColumn("date_text", F.when(
        F.col("number_of_reviews") == 3,
        F.concat(F.lit("31/02/"), F.year(d).cast("string"))).otherwise(F.date_format(d, "dd/MM/yyyy")))


@register("filter_valid_date", with_base(
    "SELECT listing_id, scraped_date FROM airbnb_raw WHERE number_of_reviews <> 3"))
def q_filter_valid_date(spark, sf):
    raw = _date_text(_L(spark, sf, ["listing_id", "scraped_date", "number_of_reviews"]).bronze["airbnb_raw"])
    parsed = raw.select("listing_id", parse_date_cascade(F.col("date_text")).alias("scraped_date"))
    return parsed.where(F.col("scraped_date").isNotNull())


@register("trailing_12m", with_base(
    "SELECT listing_id, scraped_date FROM airbnb_cleaned, span WHERE scraped_date >= oldest",
    oracle_analysis.RECENT.strip()))
def q_trailing_12m(spark, sf):
    return analysis.trailing_window(_L(spark, sf).listings).select("listing_id", "scraped_date")


@register("cross_scalar", with_base(
    "SELECT listing_id, scraped_date, newest AS anchor_dt FROM airbnb_cleaned, span WHERE scraped_date >= oldest",
    oracle_analysis.RECENT.strip()))
def q_cross_scalar(spark, sf):
    c = _L(spark, sf).listings
    anchor = c.agg(F.max("scraped_date")).scalar()
    return (c.where(F.col("scraped_date") >= minus_months(anchor, 12))
            .select("listing_id", "scraped_date", anchor.alias("anchor_dt")))


@register("filter_equals", with_base(
    "SELECT listing_id, scraped_date FROM airbnb_cleaned WHERE has_availability = 't'"))
def q_filter_equals(spark, sf):
    c = _L(spark, sf).listings
    return c.where(F.col("has_availability") == "t").select("listing_id", "scraped_date")


@register("asof_predicate", with_base("""
SELECT f.listing_id, f.scraped_date, a.valid_from, a.valid_to
FROM fact_listings f JOIN property_snapshot a ON f.listing_id = a.listing_id
 AND CAST(f.scraped_date AS TIMESTAMP) >= a.valid_from
 AND (CAST(f.scraped_date AS TIMESTAMP) < a.valid_to OR a.valid_to IS NULL)"""))
def q_asof_predicate(spark, sf):
    L = _L(spark, sf)
    return scd2.asof_join(L.fact.select("listing_id", "scraped_date"), L.property_history,
                          "listing_id", "scraped_date", [], how="inner", keep_validity=True,
                          bounded_per_key=True)


def _availability_label(a):
    return (F.when(a.isNull(), "unknown").when(a > 30, "over range")
            .when(a == 30, "vacant").when(a > 0, "part booked").otherwise("fully booked"))


@register("case_when", with_base("""
SELECT listing_id, scraped_date,
  CASE WHEN availability_30 IS NULL THEN 'unknown' WHEN availability_30 > 30 THEN 'over range'
       WHEN availability_30 = 30 THEN 'vacant' WHEN availability_30 > 0 THEN 'part booked'
       ELSE 'fully booked' END AS availability_label,
  CASE WHEN has_availability = 't' THEN 1 ELSE 0 END AS is_active
FROM airbnb_raw"""))
def q_case_when(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return raw.select("listing_id", "scraped_date",
                      _availability_label(F.col("availability_30")).alias("availability_label"),
                      F.when(F.col("has_availability") == "t", 1).otherwise(0).alias("is_active"))


@register("in_with_null", with_base(
    "SELECT listing_id, scraped_date, availability_30 IN (NULL, 30) AS vacant_or_unknown "
    "FROM airbnb_raw"))
def q_in_with_null(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    # three-valued IN: TRUE for 30, otherwise NULL (never FALSE) because of the NULL element
    in_list = F.col("availability_30").isin(F.lit(None).cast("int"), F.lit(30))
    return raw.select("listing_id", "scraped_date", in_list.alias("vacant_or_unknown"))


_AREAS = oracle_analysis.AREAS.strip()


def _lga_perf(L):
    rows = analysis.lga_rows_12m(L.listings, L.lga_suburb, L.lga_code)
    return analysis.lga_performance(analysis.listing_totals_12m(rows))


@register("literal_tag", with_base("SELECT * FROM area_tagged WHERE grp = 'top3'", _AREAS))
def q_literal_tag(spark, sf):
    return analysis.top_lgas(_lga_perf(_L(spark, sf))).withColumn("grp", F.lit(analysis.TOP_LABEL))


@register("union_all_tagged", with_base("SELECT * FROM area_tagged", _AREAS))
def q_union_all_tagged(spark, sf):
    return analysis.tagged_top_bottom(_lga_perf(_L(spark, sf)))


@register("top_k", with_base(oracle_analysis.TOP_AREAS, _AREAS))
def q_top_k(spark, sf):
    return analysis.top_lgas(_lga_perf(_L(spark, sf)))


@register("bottom_k", with_base(oracle_analysis.BOTTOM_AREAS, _AREAS))
def q_bottom_k(spark, sf):
    return analysis.bottom_lgas(_lga_perf(_L(spark, sf)))


@register("having", with_base("SELECT * FROM area_listing", _AREAS))
def q_having(spark, sf):
    L = _L(spark, sf)
    return analysis.listing_totals_12m(analysis.lga_rows_12m(L.listings, L.lga_suburb, L.lga_code))


@register("join_monthly_latest", with_base("SELECT * FROM area_month", _AREAS))
def q_join_monthly_latest(spark, sf):
    L = _L(spark, sf)
    return analysis.lga_rows_12m(L.listings, L.lga_suburb, L.lga_code)


@register("two_level_agg", with_base("SELECT * FROM area_score", _AREAS))
def q_two_level_agg(spark, sf):
    return _lga_perf(_L(spark, sf))


@register("sort_case", with_base("""
SELECT grp, lga_code_key, lga_name, avg_rev_per_active_listing FROM area_tagged
ORDER BY CASE grp WHEN 'top3' THEN 0 ELSE 1 END, avg_rev_per_active_listing DESC""", _AREAS))
def q_sort_case(spark, sf):
    s = analysis.tagged_top_bottom(_lga_perf(_L(spark, sf)))
    return (s.select("grp", "lga_code_key", "lga_name", "avg_rev_per_active_listing")
            .orderBy(F.when(F.col("grp") == analysis.TOP_LABEL, 0).otherwise(1),
                     F.col("avg_rev_per_active_listing").desc()))


# ----------------------------------------------------------------- joins ----

@register("join_normalised_text", with_base("SELECT * FROM place"))
def q_join_normalised_text(spark, sf):
    L = _L(spark, sf)
    return analysis.suburb_areas(L.lga_suburb, L.lga_code)


_PEOPLE = oracle_analysis.PEOPLE.strip()


@register("join_digits_key", with_base(f"""
SELECT {digits("g1.lga_code_2016")} AS lga_code_key, g1.tot_p_p, g2.median_age_persons,
  g2.median_mortgage_repay_monthly
FROM census_g01_cleaned g1
JOIN census_g02_cleaned g2 ON {digits("g2.lga_code_2016")} = {digits("g1.lga_code_2016")}"""))
def q_join_digits_key(spark, sf):
    L = _L(spark, sf)
    a = L.census_g01.select(digits_only(F.col("lga_code_2016")).alias("lga_code_key"), "tot_p_p")
    b = L.census_g02.select(digits_only(F.col("lga_code_2016")).alias("lga_code_key"),
                            "median_age_persons", "median_mortgage_repay_monthly")
    return a.join(b, "lga_code_key")


@register("age_band_shares", with_base("SELECT * FROM census_demo", _PEOPLE))
def q_age_band_shares(spark, sf):
    L = _L(spark, sf)
    return analysis.census_demographics(L.census_g01, L.census_g02)


@register("left_demographics", with_base("""
SELECT grp, t.lga_code_key, t.lga_name, average_household_size, pct_age_25_34
FROM area_tagged t LEFT JOIN census_demo USING (lga_code_key)""", _AREAS, _PEOPLE))
def q_left_demographics(spark, sf):
    L = _L(spark, sf)
    s = analysis.tagged_top_bottom(_lga_perf(L))
    d = analysis.census_demographics(L.census_g01, L.census_g02)
    return s.join(d, "lga_code_key", "left").select(
        "grp", "lga_code_key", "lga_name", "average_household_size", "pct_age_25_34")


@register("left_lookup", with_base("""
SELECT c.listing_id, c.scraped_date, m.lga_name, m.lga_code_key
FROM airbnb_cleaned c LEFT JOIN place m
  ON lower(trim(c.listing_neighbourhood)) = m.suburb_key"""))
def q_left_lookup(spark, sf):
    L = _L(spark, sf)
    stl = analysis.suburb_areas(L.lga_suburb, L.lga_code).select("suburb_key", "lga_name", "lga_code_key")
    c = L.listings.select("listing_id", "scraped_date",
                          lower_trim(F.col("listing_neighbourhood")).alias("suburb_key"))
    return c.join(stl, "suburb_key", "left").drop("suburb_key")


@register("left_not_null", with_base("""
SELECT c.listing_id, c.host_id, m.lga_code_key
FROM airbnb_cleaned c LEFT JOIN place m
  ON lower(trim(c.listing_neighbourhood)) = m.suburb_key
WHERE m.lga_code_key IS NOT NULL"""))
def q_left_not_null(spark, sf):
    L = _L(spark, sf)
    stl = analysis.suburb_areas(L.lga_suburb, L.lga_code).select("suburb_key", "lga_code_key")
    c = L.listings.select("listing_id", "host_id",
                          lower_trim(F.col("listing_neighbourhood")).alias("suburb_key"))
    # written as left join + NOT NULL; Catalyst plans it as an inner join
    return (c.join(stl, "suburb_key", "left").where(F.col("lga_code_key").isNotNull())
            .select("listing_id", "host_id", "lga_code_key"))


@register("scd2_double_asof", with_base(f"""
SELECT f.listing_id, f.scraped_date, a.listing_neighbourhood, h.host_is_superhost
FROM fact_listings f
{asof("a", "property_snapshot", "listing_id")}
{asof("h", "host_snapshot", "host_id")}"""))
def q_scd2_double_asof(spark, sf):
    L = _L(spark, sf).written()
    e = marts._enriched(L.fact, L.property_history, L.host_history, ["listing_neighbourhood"], L.step)
    return e.select("listing_id", "scraped_date", "listing_neighbourhood", "host_is_superhost")


_COVERAGE = oracle_analysis.COVERAGE.strip()


@register("join_using", with_base(
    "SELECT host_id, listing_id, rev_12m_c FROM earned JOIN single USING (host_id)", _COVERAGE))
def q_join_using(spark, sf):
    L = _L(spark, sf)
    earned = analysis.tenures_12m(L.listings, analysis.suburb_areas(L.lga_suburb, L.lga_code)).where("nights > 0")
    return (earned.join(analysis.single_listing_hosts(L.listings), "host_id")
            .select("host_id", "listing_id", F.col("cents").alias("rev_12m_c")))


@register("covers_flag", with_base("""
SELECT host_id, listing_id, lga_name, lga_code_key, CAST(rev_12m_c AS DOUBLE) / 100 AS revenue_12m,
  CAST(pay * 12 AS BIGINT) AS annual_mortgage, covers_flag
FROM cover""", _COVERAGE))
def q_covers_flag(spark, sf):
    L = _L(spark, sf)
    return analysis.mortgage_cover(L.listings, L.lga_suburb, L.lga_code, L.census_g02)


_KINDS = oracle_analysis.KINDS.strip()


@register("semi_restrict", with_base("SELECT * FROM kind SEMI JOIN hood_top USING (suburb_key)", _KINDS))
def q_semi_restrict(spark, sf):
    perf = analysis.listing_type_performance(_L(spark, sf).listings)
    return perf.join(analysis.top_neighbourhoods(perf).select("suburb_key"), "suburb_key", "left_semi")


@register("best_combo_per_group", with_base("SELECT * FROM kind_best", _KINDS))
def q_best_combo_per_group(spark, sf):
    perf = analysis.listing_type_performance(_L(spark, sf).listings)
    return analysis.best_combo_per_neighbourhood(perf)


_HOODS = oracle_analysis.HOODS.strip()


@register("join_aggregates", with_base("SELECT * FROM hood_pair", _HOODS))
def q_join_aggregates(spark, sf):
    L = _L(spark, sf)
    return analysis.age_revenue_pairs(L.listings, L.lga_suburb, L.lga_code, L.census_g02)


@register("sort_metric", with_base(
    "SELECT * FROM hood_score ORDER BY revenue_per_active_listing DESC", _HOODS))
def q_sort_metric(spark, sf):
    return (analysis.neighbourhood_revenue(_L(spark, sf).listings)
            .orderBy(F.col("revenue_per_active_listing").desc()))


@register("anti_new_keys", with_base("""
SELECT m.listing_id, m.scraped_date, m.l_orderkey, m.l_linenumber
FROM mapped m
WHERE NOT EXISTS (SELECT 1 FROM airbnb_raw t WHERE t.scraped_date < DATE '1998-01-01'
                  AND t.listing_id = m.listing_id AND t.scraped_date = m.scraped_date)"""))
def q_anti_new_keys(spark, sf):
    from lodgelake.sources import testdata
    batch = testdata.listing_rows(spark, sf)
    target = _L(spark, sf).bronze["airbnb_raw"].where(F.col("scraped_date") < F.lit("1998-01-01").cast("date"))
    new = without_keys_of(batch, target, ["listing_id", "scraped_date"])
    return new.select("listing_id", "scraped_date", "l_orderkey", "l_linenumber")


# ---------------------------------------------------------- aggregations ----

@register("group_by", with_base(
    "SELECT property_type, room_type, count(*) AS n_rows FROM airbnb_cleaned GROUP BY 1, 2"))
def q_group_by(spark, sf):
    return (_L(spark, sf).listings.groupBy("property_type", "room_type")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("agg_count", with_base(
    "SELECT listing_neighbourhood, CAST(count(*) AS INTEGER) AS total_listings_count "
    "FROM airbnb_cleaned GROUP BY 1"))
def q_agg_count(spark, sf):
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood")
            .agg(F.count(F.lit(1)).cast("int").alias("total_listings_count")))


@register("agg_count_distinct", with_base(
    "SELECT listing_neighbourhood, count(DISTINCT host_id) AS distinct_hosts "
    "FROM airbnb_cleaned GROUP BY 1"))
def q_agg_count_distinct(spark, sf):
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood")
            .agg(F.count_distinct("host_id").alias("distinct_hosts")))


@register("agg_count_distinct_if", with_base(
    "SELECT listing_neighbourhood, count(DISTINCT CASE WHEN host_is_superhost = 't' "
    "THEN host_id END) AS distinct_superhosts FROM airbnb_cleaned GROUP BY 1"))
def q_agg_count_distinct_if(spark, sf):
    c = F.col
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood")
            .agg(F.count_distinct(F.when(c("host_is_superhost") == "t", c("host_id")))
                 .alias("distinct_superhosts")))


@register("agg_sum", with_base(
    "SELECT room_type, CAST(sum(availability_30) AS BIGINT) AS sum_availability, "
    "CAST(sum(number_of_reviews) AS BIGINT) AS sum_reviews, CAST(sum(price) AS DOUBLE) AS sum_price "
    "FROM airbnb_cleaned GROUP BY 1"))
def q_agg_sum(spark, sf):
    return (_L(spark, sf).listings.groupBy("room_type").agg(
        F.sum("availability_30").cast("bigint").alias("sum_availability"),
        F.sum("number_of_reviews").cast("bigint").alias("sum_reviews"),
        F.sum("price").cast("double").alias("sum_price")))


@register("agg_sum_if", with_base(f"""
SELECT listing_neighbourhood,
  CAST(sum(CASE WHEN has_availability = 't' THEN {stays("availability_30")} ELSE 0 END) AS BIGINT)
    AS total_active_stays,
  CAST(sum(CASE WHEN has_availability = 't' THEN 1 ELSE 0 END) AS BIGINT) AS active_ct
FROM airbnb_cleaned GROUP BY 1"""))
def q_agg_sum_if(spark, sf):
    act = F.col("has_availability") == "t"
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood").agg(
        F.sum(F.when(act, stays_30(F.col("availability_30"))).otherwise(0)).cast("bigint")
        .alias("total_active_stays"),
        F.sum(F.when(act, 1).otherwise(0)).cast("bigint").alias("active_ct")))


@register("agg_avg", with_base(f"""
SELECT property_type,
  {quotient("sum(CAST(review_scores_rating * 100 AS BIGINT))", "count(review_scores_rating) * 100")}
    AS avg_rating
FROM airbnb_cleaned GROUP BY 1"""))
def q_agg_avg(spark, sf):
    r = (F.col("review_scores_rating") * 100).cast("decimal(38,0)")
    return (_L(spark, sf).listings.groupBy("property_type")
            .agg(exact_quotient(F.sum(r), F.count("review_scores_rating") * 100).alias("avg_rating")))


@register("agg_avg_filter", with_base(f"""
SELECT listing_neighbourhood,
  {quotient(f"sum({sql_cents('price')}) FILTER (WHERE has_availability = 't')",
            "count(price) FILTER (WHERE has_availability = 't') * 100")} AS avg_active_price
FROM airbnb_cleaned GROUP BY 1"""))
def q_agg_avg_filter(spark, sf):
    act = F.col("has_availability") == "t"
    pc = cents(F.col("price")).cast("decimal(38,0)")
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood").agg(
        exact_quotient(F.sum(F.when(act, pc)), F.count(F.when(act, F.col("price"))) * 100)
        .alias("avg_active_price")))


@register("agg_minmax_filter", with_base("""
SELECT listing_neighbourhood,
  CAST(min(price) FILTER (WHERE has_availability = 't') AS DOUBLE) AS min_active_price,
  CAST(max(price) FILTER (WHERE has_availability = 't') AS DOUBLE) AS max_active_price
FROM airbnb_cleaned GROUP BY 1"""))
def q_agg_minmax_filter(spark, sf):
    act = F.col("has_availability") == "t"
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood").agg(
        F.min(F.when(act, F.col("price"))).cast("double").alias("min_active_price"),
        F.max(F.when(act, F.col("price"))).cast("double").alias("max_active_price")))


@register("agg_median_filter", with_base(f"""
SELECT listing_neighbourhood, {MONTH} AS month_start,
  quantile_cont({sql_cents("price")}, 0.5) FILTER (WHERE has_availability = 't') / 100
    AS median_active_price
FROM airbnb_cleaned GROUP BY 1, 2"""))
def q_agg_median_filter(spark, sf):
    act = F.col("has_availability") == "t"
    c = _L(spark, sf).listings
    keys = ["listing_neighbourhood", "month_start"]
    c = c.withColumn("month_start", month_bucket(F.col("scraped_date")))
    med = exact_median(c.where(act), keys, cents(F.col("price")), "_cents")
    med = med.select(*[F.col(k).alias(f"_{k}") for k in keys], "_cents")
    groups = c.select(*keys).distinct()  # a group without an active row has no median
    return (groups.join(med, [groups[k].eqNullSafe(med[f"_{k}"]) for k in keys], "left")
            .select(*keys, (F.col("_cents") / 100).alias("median_active_price")))


@register("agg_global_max", with_base(
    "SELECT max(scraped_date) AS anchor_dt, min(scraped_date) AS first_dt FROM airbnb_cleaned"))
def q_agg_global_max(spark, sf):
    return _L(spark, sf).listings.agg(F.max("scraped_date").alias("anchor_dt"),
                                      F.min("scraped_date").alias("first_dt"))


@register("monthly_latest_date", with_base(
    f"SELECT listing_id, {MONTH} AS month_start, max(scraped_date) AS last_dt "
    "FROM airbnb_cleaned GROUP BY 1, 2"))
def q_monthly_latest_date(spark, sf):
    c = _L(spark, sf).listings
    return (c.groupBy("listing_id", month_bucket(F.col("scraped_date")).alias("month_start"))
            .agg(F.max("scraped_date").alias("last_dt")))


@register("safe_ratio", with_base(f"""
SELECT listing_neighbourhood,
  CAST(sum(number_of_reviews) AS DOUBLE)
    / nullif(CAST(sum(CASE WHEN has_availability = 't' THEN 1 ELSE 0 END) AS DOUBLE), 0)
    AS reviews_per_active_row
FROM airbnb_cleaned GROUP BY 1"""))
def q_safe_ratio(spark, sf):
    act = F.when(F.col("has_availability") == "t", 1).otherwise(0)
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood").agg(
        safe_ratio(F.sum("number_of_reviews").cast("double"), F.sum(act).cast("double"))
        .alias("reviews_per_active_row")))


@register("guarded_ratio", with_base(f"""
SELECT listing_neighbourhood,
  CASE WHEN sum(CASE WHEN has_availability = 't' THEN 1 ELSE 0 END) > 0 THEN
    {quotient(f"sum((CASE WHEN has_availability = 't' THEN {stays('availability_30')} ELSE 0 END)"
              f" * {sql_cents('price')})",
              "sum(CASE WHEN has_availability = 't' THEN 1 ELSE 0 END) * 100")} END
    AS avg_estimated_rev_per_active_row
FROM airbnb_cleaned GROUP BY 1"""))
def q_guarded_ratio(spark, sf):
    act = F.col("has_availability") == "t"
    rev = (F.when(act, stays_30(F.col("availability_30"))).otherwise(0)
           * cents(F.col("price"))).cast("decimal(38,0)")
    n = F.sum(F.when(act, 1).otherwise(0))
    return (_L(spark, sf).listings.groupBy("listing_neighbourhood").agg(
        F.when(n > 0, exact_quotient(F.sum(rev), n * 100)).alias("avg_estimated_rev_per_active_row")))


@register("select_distinct", with_base(
    "SELECT DISTINCT host_id, host_neighbourhood FROM airbnb_cleaned"))
def q_select_distinct(spark, sf):
    return _L(spark, sf).listings.select("host_id", "host_neighbourhood").distinct()


@register("label_histogram", with_base("""
SELECT CASE WHEN availability_30 IS NULL THEN 'unknown' WHEN availability_30 > 30 THEN 'over range'
       WHEN availability_30 = 30 THEN 'vacant' WHEN availability_30 > 0 THEN 'part booked'
       ELSE 'fully booked' END AS availability_label, count(*) AS n_rows
FROM airbnb_raw GROUP BY 1 ORDER BY 1"""))
def q_label_histogram(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return (raw.groupBy(_availability_label(F.col("availability_30")).alias("availability_label"))
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy("availability_label"))


# --------------------------------------------------------------- windows ----

@register("latest_per_month", with_base(f"""
SELECT listing_id, month_start, scraped_date, price FROM (
  SELECT *, {MONTH} AS month_start, row_number() OVER (
    PARTITION BY listing_id, date_trunc('month', scraped_date) ORDER BY scraped_date DESC) AS rn
  FROM airbnb_cleaned) z WHERE rn = 1"""))
def q_latest_per_month(spark, sf):
    c = _L(spark, sf).listings.select("listing_id", "scraped_date", "price")
    return analysis.monthly_latest(c).select("listing_id", "month_start", "scraped_date", "price")


@register("max_stays_per_month", with_base(f"""
SELECT listing_id, month_start, scraped_date, stays_in_30_days FROM (
  SELECT *, {MONTH} AS month_start, {stays("availability_30")} AS stays_in_30_days,
    row_number() OVER (PARTITION BY listing_id, date_trunc('month', scraped_date)
      ORDER BY {stays("availability_30")} DESC, scraped_date DESC) AS rn
  FROM airbnb_cleaned) z WHERE rn = 1"""))
def q_max_stays_per_month(spark, sf):
    c = _L(spark, sf).listings.select(
        "listing_id", "scraped_date", month_bucket(F.col("scraped_date")).alias("month_start"),
        stays_30(F.col("availability_30")).alias("stays_in_30_days"))
    return top1_window(c, ["listing_id", "month_start"],
                       [F.col("stays_in_30_days").desc(), F.col("scraped_date").desc()])


@register("distinct_on_latest", with_base("""
SELECT listing_id, host_id, listing_neighbourhood, scraped_date FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_date DESC) AS rn
  FROM airbnb_cleaned) z WHERE rn = 1"""))
def q_distinct_on_latest(spark, sf):
    c = _L(spark, sf).listings.select("listing_id", "host_id", "listing_neighbourhood", "scraped_date")
    return latest_per_key(c, ["listing_id"], ["scraped_date"])


_MONTHLY_COUNTS = f"""
monthly_counts AS (
  SELECT listing_neighbourhood, month_start, CAST(sum(a) AS BIGINT) AS active_ct,
    CAST(sum(1 - a) AS BIGINT) AS inactive_ct
  FROM (SELECT listing_neighbourhood, {MONTH} AS month_start,
          CASE WHEN has_availability = 't' THEN 1 ELSE 0 END AS a FROM airbnb_cleaned) t
  GROUP BY 1, 2
)"""


def _monthly_counts(c, keys):
    a = F.when(F.col("has_availability") == "t", 1).otherwise(0)
    return (c.groupBy(*keys, month_bucket(F.col("scraped_date")).alias("month_start"))
            .agg(F.sum(a).alias("active_ct"), F.sum(1 - a).alias("inactive_ct")))


@register("lag_prev_month", with_base("""
SELECT listing_neighbourhood, month_start, active_ct,
  lag(active_ct) OVER (PARTITION BY listing_neighbourhood ORDER BY month_start) AS prev_active_ct
FROM monthly_counts""", _MONTHLY_COUNTS.strip()))
def q_lag_prev_month(spark, sf):
    m = _monthly_counts(_L(spark, sf).listings, ["listing_neighbourhood"])
    w = Window.partitionBy("listing_neighbourhood").orderBy("month_start")
    return m.select("listing_neighbourhood", "month_start", "active_ct",
                    F.lag("active_ct").over(w).alias("prev_active_ct"))


@register("lag_prev_month_multi", with_base(f"""
SELECT property_type, room_type, accommodates, month_start, inactive_ct,
  lag(inactive_ct) OVER (PARTITION BY property_type, room_type, accommodates
                         ORDER BY month_start) AS prev_inactive_ct
FROM (SELECT property_type, room_type, accommodates, {MONTH} AS month_start,
        CAST(sum(CASE WHEN has_availability = 't' THEN 0 ELSE 1 END) AS BIGINT) AS inactive_ct
      FROM airbnb_cleaned GROUP BY 1, 2, 3, 4) t"""))
def q_lag_prev_month_multi(spark, sf):
    keys = ["property_type", "room_type", "accommodates"]
    m = _monthly_counts(_L(spark, sf).listings, keys)
    w = Window.partitionBy(*keys).orderBy("month_start")
    return m.select(*keys, "month_start", "inactive_ct",
                    F.lag("inactive_ct").over(w).alias("prev_inactive_ct"))


@register("pct_change_mom", with_base(f"""
SELECT listing_neighbourhood, month_start,
  CASE WHEN prev IS NULL OR prev = 0 THEN NULL
       ELSE {ratio("100 * (active_ct - prev)", "prev")} END AS pct_change_active_listings
FROM (SELECT *, lag(active_ct) OVER (PARTITION BY listing_neighbourhood ORDER BY month_start) AS prev
      FROM monthly_counts) t""", _MONTHLY_COUNTS.strip()))
def q_pct_change_mom(spark, sf):
    m = _monthly_counts(_L(spark, sf).listings, ["listing_neighbourhood"])
    w = Window.partitionBy("listing_neighbourhood").orderBy("month_start")
    prev = F.lag("active_ct").over(w)
    return m.select("listing_neighbourhood", "month_start",
                    pct_change_rounded(F.col("active_ct"), prev).alias("pct_change_active_listings"))


# ----------------------------------------------------------------- sorts ----

@register("sort_multi", with_base(
    "SELECT listing_neighbourhood, scraped_date, listing_id FROM airbnb_cleaned "
    "ORDER BY listing_neighbourhood, scraped_date, listing_id"))
def q_sort_multi(spark, sf):
    return (_L(spark, sf).listings.select("listing_neighbourhood", "scraped_date", "listing_id")
            .orderBy("listing_neighbourhood", "scraped_date", "listing_id"))


@register("sort_nulls_last", with_base(f"""
SELECT listing_neighbourhood, {MONTH} AS month_start,
  min(CASE WHEN has_availability = 't' THEN price END) AS min_active_price
FROM airbnb_cleaned GROUP BY 1, 2
ORDER BY min_active_price DESC NULLS LAST, listing_neighbourhood ASC NULLS LAST, month_start"""))
def q_sort_nulls_last(spark, sf):
    c = _L(spark, sf).listings
    act = F.col("has_availability") == "t"
    g = c.groupBy("listing_neighbourhood", month_bucket(F.col("scraped_date")).alias("month_start")).agg(
        F.min(F.when(act, F.col("price"))).alias("min_active_price"))
    return g.orderBy(F.col("min_active_price").desc_nulls_last(),
                     F.col("listing_neighbourhood").asc_nulls_last(), "month_start")


# -------------------------------------------------------- scalar functions --

@register("str_lower_trim", with_base(
    "SELECT listing_id, scraped_date, lower(trim('  ' || upper(listing_neighbourhood) || '  ')) "
    "AS suburb_key FROM airbnb_cleaned"))
def q_str_lower_trim(spark, sf):
    c = _L(spark, sf).listings
    padded = F.concat(F.lit("  "), F.upper(F.col("listing_neighbourhood")), F.lit("  "))
    return c.select("listing_id", "scraped_date", lower_trim(padded).alias("suburb_key"))


_INITCAP_SRC = "room_type || '''s ' || lower(property_type) || '-' || listing_neighbourhood"


@register("str_initcap_pg", with_base(
    f"SELECT listing_id, {initcap(_INITCAP_SRC)} AS label FROM (SELECT DISTINCT listing_id, "
    "room_type, property_type, listing_neighbourhood FROM airbnb_cleaned) t"))
def q_str_initcap_pg(spark, sf):
    c = _L(spark, sf).listings.select("listing_id", "room_type", "property_type",
                                      "listing_neighbourhood").distinct()
    src = F.concat(F.col("room_type"), F.lit("'s "), F.lower(F.col("property_type")), F.lit("-"),
                   F.col("listing_neighbourhood"))
    return c.select("listing_id", initcap_words(src).alias("label"))


@register("digits_only", with_base(
    f"SELECT DISTINCT host_id, {digits('host_name')} AS host_digits FROM airbnb_cleaned"))
def q_digits_only(spark, sf):
    c = _L(spark, sf).listings
    return c.select("host_id", digits_only(F.col("host_name")).alias("host_digits")).distinct()


@register("clean_price", with_base(
    "SELECT listing_id, scraped_date, price AS price_text, "
    "TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DECIMAL(18,2)) AS price FROM airbnb_raw"))
def q_clean_price(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return raw.select("listing_id", "scraped_date", F.col("price").alias("price_text"),
                      clean_price(F.col("price")).alias("price"))


@register("null_sentinels", with_base("""
SELECT listing_id, scraped_date,
  CASE WHEN s IN ('', 'NaT', 'NULL') THEN NULL ELSE s END AS host_is_superhost,
  CASE WHEN d IN ('', 'NaT', 'NULL') THEN NULL ELSE d END AS host_since_text
FROM (SELECT listing_id, scraped_date, trim(coalesce(host_is_superhost, ' NULL ')) AS s,
        trim(coalesce(CAST(host_since AS VARCHAR), 'NaT')) AS d FROM airbnb_raw) t"""))
def q_null_sentinels(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    s = F.coalesce(F.col("host_is_superhost"), F.lit(" NULL "))
    d = F.coalesce(F.col("host_since").cast("string"), F.lit("NaT"))
    return raw.select("listing_id", "scraped_date", null_sentinels(s).alias("host_is_superhost"),
                      null_sentinels(d).alias("host_since_text"))


@register("format_month", with_base(
    f"SELECT DISTINCT {MONTH} AS month_start, strftime(scraped_date, '%Y-%m') AS month_year "
    "FROM airbnb_cleaned"))
def q_format_month(spark, sf):
    c = _L(spark, sf).listings
    return c.select(month_bucket(F.col("scraped_date")).alias("month_start"),
                    format_month(F.col("scraped_date")).alias("month_year")).distinct()


@register("month_bucket", with_base(
    f"SELECT listing_id, scraped_date, {MONTH} AS month_start FROM airbnb_cleaned"))
def q_month_bucket(spark, sf):
    c = _L(spark, sf).listings
    return c.select("listing_id", "scraped_date", month_bucket(F.col("scraped_date")).alias("month_start"))


@register("date_minus_interval", with_base(
    "SELECT DISTINCT scraped_date, CAST(scraped_date - INTERVAL 12 MONTH AS DATE) AS year_before "
    "FROM airbnb_cleaned"))
def q_date_minus_interval(spark, sf):
    c = _L(spark, sf).listings
    return c.select("scraped_date", minus_months(F.col("scraped_date"), 12).alias("year_before")).distinct()


@register("cast_temporal", with_base(
    "SELECT listing_id, scraped_date, CAST(scraped_date AS TIMESTAMP) AS updated_at, "
    "CAST(CAST(host_since AS VARCHAR) AS DATE) AS host_since FROM airbnb_cleaned"))
def q_cast_temporal(spark, sf):
    c = _L(spark, sf).listings
    return c.select("listing_id", "scraped_date",
                    F.col("scraped_date").cast("timestamp_ntz").alias("updated_at"),
                    F.col("host_since").cast("string").cast("date").alias("host_since"))


# layouts a scrape date is written in, by (listing + line number) mod 12
_LAYOUTS = ["d/M/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "'x'", "' '", "d-M-yyyy",
            "yyyy-MM-dd'T'10:00:00", "yyyy-MM-dd 00:00:00", "d MMM yyyy", "MMMM d, yyyy"]


def _date_variants(df):
    """Scrape date written in one of several layouts (two of them no date)."""
    d, n = F.col("scraped_date"), F.pmod(F.col("listing_id") + F.col("number_of_reviews"), F.lit(len(_LAYOUTS)))
    text = F.lit(None).cast("string")
    for k, layout in enumerate(_LAYOUTS):
        text = F.when(n == k, F.date_format(d, layout)).otherwise(text)
    return df.withColumn("date_text", text)


def _parsed(swapped: str) -> str:
    """What each layout reads as, stated from the scrape date itself; the listed
    layouts swap day and month where both readings are dates."""
    return f"""
SELECT listing_id, scraped_date,
  CASE WHEN n IN (5, 6) THEN NULL
       WHEN n IN ({swapped}) AND day(scraped_date) <= 12
         THEN make_date(year(scraped_date), day(scraped_date), month(scraped_date))
       ELSE scraped_date END AS parsed
FROM (SELECT *, (listing_id + number_of_reviews) % 12 AS n FROM airbnb_raw)"""


# slashes are read day-first, so month-first text swaps; dashes month-first
@register("parse_date_cascade", with_base(_parsed("4, 7")))
def q_parse_date_cascade(spark, sf):
    raw = _date_variants(_L(spark, sf).bronze["airbnb_raw"])
    return raw.select("listing_id", "scraped_date", parse_date_cascade(F.col("date_text")).alias("parsed"))


# the file's month decides, so nothing swaps
@register("parse_date_month_locked", with_base(_parsed("-1")))
def q_parse_date_month_locked(spark, sf):
    raw = _date_variants(_L(spark, sf).bronze["airbnb_raw"])
    return raw.select("listing_id", "scraped_date",
                      parse_date_month_locked(F.col("date_text"), F.month("scraped_date")).alias("parsed"))


@register("parse_date_dayfirst", with_base(_parsed("4")))
def q_parse_date_dayfirst(spark, sf):
    raw = _date_variants(_L(spark, sf).bronze["airbnb_raw"])
    return raw.select("listing_id", "scraped_date", parse_date_dayfirst(F.col("date_text")).alias("parsed"))


@register("coalesce_defaults", with_base("""
SELECT listing_id, scraped_date, host_name, host_since, host_is_superhost, host_neighbourhood,
  availability_30, review_scores_accuracy FROM airbnb_cleaned"""))
def q_coalesce_defaults(spark, sf):
    return _L(spark, sf).listings.select(
        "listing_id", "scraped_date", "host_name", "host_since", "host_is_superhost",
        "host_neighbourhood", "availability_30", "review_scores_accuracy")


@register("coalesce_fallback", with_base(f"""
SELECT f.listing_id, f.scraped_date, coalesce(l.lga_name, h.host_neighbourhood) AS host_neighbourhood_lga
FROM fact_listings f
{asof("h", "host_snapshot", "host_id")}
LEFT JOIN (SELECT lower(suburb_name) AS suburb_lc, lga_name FROM lga_suburb_cleaned) l
  ON lower(h.host_neighbourhood) = l.suburb_lc"""))
def q_coalesce_fallback(spark, sf):
    L = _L(spark, sf).written()
    e = scd2.asof_join(L.fact.select("listing_id", "scraped_date", "host_id"), L.host_history,
                       "host_id", "scraped_date", ["host_neighbourhood"])
    sub = L.lga_suburb.select(F.lower(F.col("suburb_name")).alias("_lc"), F.col("lga_name"))
    e = e.join(sub, F.lower(F.col("host_neighbourhood")) == F.col("_lc"), "left")
    return e.select("listing_id", "scraped_date",
                    F.coalesce(F.col("lga_name"), F.col("host_neighbourhood")).alias("host_neighbourhood_lga"))


@register("round_half_up", with_base(f"""
SELECT listing_neighbourhood,
  {ratio(f"sum({sql_cents('price')})", "count(price) * 100")} AS avg_price_2dp,
  {ratio("sum(availability_30)", "count(availability_30)", 3)} AS avg_availability_3dp
FROM airbnb_cleaned GROUP BY 1"""))
def q_round_half_up(spark, sf):
    c = _L(spark, sf).listings
    return c.groupBy("listing_neighbourhood").agg(
        ratio_half_up(F.sum(cents(F.col("price")).cast("decimal(38,0)")), F.count("price") * 100)
        .alias("avg_price_2dp"),
        ratio_half_up(F.sum("availability_30"), F.count("availability_30"), 3)
        .alias("avg_availability_3dp"))


@register("stays_30", with_base(
    f"SELECT listing_id, scraped_date, {stays('availability_30')} AS stays_in_30_days FROM airbnb_raw"))
def q_stays_30(spark, sf):
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return raw.select("listing_id", "scraped_date", stays_30(F.col("availability_30")).alias("stays_in_30_days"))


@register("stays_30_clamped", with_base(
    f"SELECT listing_id, scraped_date, {stays_clamped('30 - availability_30 * 2')} AS stays_30 "
    "FROM airbnb_raw"))
def q_stays_30_clamped(spark, sf):
    # 30 - 2a spans -70..28, so both clamps are exercised
    raw = _L(spark, sf).bronze["airbnb_raw"]
    return raw.select("listing_id", "scraped_date",
                      stays_30_clamped(30 - F.col("availability_30") * 2).alias("stays_30"))


@register("revenue_30", with_base(
    f"SELECT listing_id, scraped_date, CAST(coalesce(price, 0) * {stays_clamped('availability_30')} "
    "AS DOUBLE) AS revenue_30 FROM airbnb_cleaned"))
def q_revenue_30(spark, sf):
    c = _L(spark, sf).listings
    rev = F.coalesce(F.col("price"), F.lit(0)) * stays_30_clamped(F.col("availability_30"))
    return c.select("listing_id", "scraped_date", rev.cast("double").alias("revenue_30"))


@register("cast_numeric", with_base(
    "SELECT listing_id, scraped_date, CAST(availability_30 AS BIGINT) AS availability_30, "
    "CAST(price AS DOUBLE) AS price, CAST(review_scores_rating AS DOUBLE) AS rating, "
    "CAST(accommodates AS VARCHAR) AS accommodates_text FROM airbnb_cleaned"))
def q_cast_numeric(spark, sf):
    c = _L(spark, sf).listings
    return c.select("listing_id", "scraped_date", F.col("availability_30").cast("bigint").alias("availability_30"),
                    F.col("price").cast("double").alias("price"),
                    F.col("review_scores_rating").cast("double").alias("rating"),
                    F.col("accommodates").cast("string").alias("accommodates_text"))
