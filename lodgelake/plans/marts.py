"""Data marts: monthly KPIs per listing neighbourhood, per property type and
per host LGA.

Plan shape (each mart): fact scan -> point-in-time lookups into the history
tables -> one row per (listing, month) -> one hash aggregation per group and
month (partial aggregation map-side; distinct counts via Spark's two-level
distinct rewrite, so a hot group is spread over (group, host) keys) -> a
``lag`` window whose groups hold one row per month.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions import (
    cents, exact_quotient, format_month, month_bucket, pct_change_exact,
    pct_change_rounded, ratio_half_up, round_cents_half_up, stays_30,
)
from lodgelake.operators import scd2
from lodgelake.operators.dedupe import latest_per_key
from lodgelake.operators.median import exact_median

UNKNOWN_AREA = "Unknown"  # fixed value: label of facts without a matching version


#: Takes a frame and a name and returns the same rows, written in between or not.
Step = Callable[[DataFrame, str], DataFrame]


def _in_one(df: DataFrame, _name: str) -> DataFrame:
    return df


def _base_fact(fact: DataFrame) -> DataFrame:
    return fact.select(
        "listing_id", "host_id", F.col("scraped_date").cast("date").alias("scraped_date"),
        month_bucket(F.col("scraped_date")).alias("month_start"),
        "price", "has_availability", "availability_30", "review_scores_rating")


def _enrich(facts: DataFrame, prop_hist: DataFrame, host_hist: DataFrame,
            prop_attrs: list[str], probes: DataFrame | None = None, step: Step = _in_one) -> DataFrame:
    """Point-in-time listing and host attributes, plus the activity flags; each
    lookup is a ``step``.

    The listing lookup sends the facts themselves through the window (a
    listing has at most one fact per date); the host lookup goes through the
    distinct (host, date) pairs because one host may own very many listings.
    """
    e = scd2.asof_join(facts, prop_hist, "listing_id", "scraped_date", prop_attrs,
                       bounded_per_key=True)
    e = step(e, "with-listing")
    e = scd2.asof_join(e, host_hist, "host_id", "scraped_date", ["host_is_superhost"],
                       probes=probes)
    e = step(e, "with-host")
    return (e.withColumn("is_active", F.when(F.col("has_availability") == "t", 1).otherwise(0))
            .withColumn("stays_in_30_days", stays_30(F.col("availability_30"))))


def _enriched(fact: DataFrame, prop_hist: DataFrame, host_hist: DataFrame,
              prop_attrs: list[str], step: Step = _in_one) -> DataFrame:
    """Every fact with its point-in-time attributes (no monthly reduction)."""
    return _enrich(_base_fact(fact), prop_hist, host_hist, prop_attrs, step=step)


def _latest_enriched(fact: DataFrame, prop_hist: DataFrame, host_hist: DataFrame,
                     prop_attrs: list[str], step: Step = _in_one) -> DataFrame:
    """One row per (listing, month) - the latest scrape - with its attributes.

    The monthly pick depends on the scrape date only and each lookup is per
    row, so picking first and looking up second gives the same rows while the
    lookups see one row per listing and month instead of one per scrape.
    """
    base = _base_fact(fact)
    latest = step(latest_per_key(base, ["listing_id", "month_start"], ["scraped_date"]), "latest")
    # what is written is read again at no cost; else the scan it was picked from is cheaper
    return _enrich(latest, prop_hist, host_hist, prop_attrs, probes=base if step is _in_one else None, step=step)


def _aggregate(latest: DataFrame, keys: list[str], active_superhost_only: bool) -> DataFrame:
    """Exact integer ingredients of every KPI per group (cents, hundredths, counts).

    Two hash aggregations instead of one with distinct aggregates: first per
    (group, host) - every additive figure plus the host's superhost flag - then
    per group, where counting host rows gives the distinct hosts.  The median
    comes from a value histogram (``exact_median``).  No step keeps per-group
    object buffers, so every step combines map-side and spills gracefully.
    """
    act = F.col("is_active") == 1
    price_c = cents(F.col("price"))
    rev_c = (F.when(act, F.col("stays_in_30_days")).otherwise(0) * price_c).cast("decimal(38,0)")
    super_cond = F.col("host_is_superhost") == "t"
    if active_superhost_only:
        super_cond = act & super_cond
    per_host = latest.groupBy(*keys, "host_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_active").alias("active"),
        F.min(F.when(act, F.col("price"))).alias("min_p"),
        F.max(F.when(act, F.col("price"))).alias("max_p"),
        F.sum(F.when(act, price_c.cast("decimal(38,0)"))).alias("sum_c"),
        F.count(F.when(act, price_c)).alias("n_priced"),
        F.sum(F.when(act, (F.col("review_scores_rating") * 100).cast("decimal(38,0)"))).alias("sum_r"),
        F.count(F.when(act, F.col("review_scores_rating"))).alias("n_rated"),
        F.sum(F.when(act, F.col("stays_in_30_days")).otherwise(0)).alias("stays"),
        F.sum(rev_c).alias("rev"),
        F.max(F.when(super_cond, 1).otherwise(0)).alias("is_super"))
    has_host = F.col("host_id").isNotNull()
    agg = per_host.groupBy(*keys).agg(
        F.sum("n").alias("total_listings_count"),
        F.sum("active").alias("active_ct"),
        (F.sum("n") - F.sum("active")).alias("inactive_ct"),
        F.min("min_p").alias("min_active_price"),
        F.max("max_p").alias("max_active_price"),
        F.sum("sum_c").alias("sum_active_cents"),
        F.sum("n_priced").alias("n_active_priced"),
        F.count("host_id").alias("distinct_hosts_count"),
        F.sum(F.when(has_host, F.col("is_super")).otherwise(0)).alias("superhosts"),
        F.sum("sum_r").alias("sum_active_rating"),
        F.sum("n_rated").alias("n_active_rated"),
        F.sum("stays").cast("bigint").alias("total_active_stays"),
        F.sum("rev").alias("sum_rev_cents"))
    med = exact_median(latest.where(act), keys, price_c, "median_active_cents")
    med = med.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "median_active_cents")
    same = [agg[k].eqNullSafe(med[f"_m_{k}"]) for k in keys]  # a NULL key is a group too
    return agg.join(med, same, "left").drop(*[f"_m_{k}" for k in keys])


MONTHLY_ATTRS = ["listing_neighbourhood", "property_type", "room_type", "accommodates"]


def monthly_fact(fact: DataFrame, prop_hist: DataFrame, host_hist: DataFrame, step: Step = _in_one) -> DataFrame:
    """One row per (listing, month): the latest scrape with the listing and host
    attributes valid at its date - the shared input of the two KPI marts, worth
    materialising once as a monthly-grain fact table."""
    return _latest_enriched(fact, prop_hist, host_hist, MONTHLY_ATTRS, step)


def mart_listing_neighbourhood(fact: DataFrame, prop_hist: DataFrame,
                               host_hist: DataFrame, step: Step = _in_one) -> DataFrame:
    """KPIs per listing neighbourhood and month, rounded to 2 decimals."""
    return listing_neighbourhood_kpis(
        _latest_enriched(fact, prop_hist, host_hist, ["listing_neighbourhood"], step))


def neighbourhood_parts(latest: DataFrame) -> DataFrame:
    """The exact ingredients of the neighbourhood mart: a row per neighbourhood
    and month, from that month's rows alone."""
    area = F.coalesce(F.col("listing_neighbourhood"), F.lit(UNKNOWN_AREA))
    return _aggregate(latest.withColumn("listing_neighbourhood", area),
                      ["listing_neighbourhood", "month_start"], active_superhost_only=False)


def listing_neighbourhood_kpis(latest: DataFrame) -> DataFrame:
    """The neighbourhood mart from the monthly fact."""
    return neighbourhood_from_parts(neighbourhood_parts(latest))


def neighbourhood_from_parts(a: DataFrame) -> DataFrame:
    """The neighbourhood mart from its ingredients of all months."""
    w = Window.partitionBy("listing_neighbourhood").orderBy("month_start")
    a = (a.withColumn("prev_active_ct", F.lag("active_ct").over(w))
          .withColumn("prev_inactive_ct", F.lag("inactive_ct").over(w)))
    c = F.col
    return a.select(
        "listing_neighbourhood", "month_start",
        format_month(c("month_start")).alias("month_year"),
        ratio_half_up(c("active_ct") * 100, c("total_listings_count")).alias("active_listings_rate"),
        F.round(c("min_active_price"), 2).cast("double").alias("min_active_price"),
        F.round(c("max_active_price"), 2).cast("double").alias("max_active_price"),
        round_cents_half_up(c("median_active_cents")).alias("median_active_price"),
        ratio_half_up(c("sum_active_cents"), c("n_active_priced") * 100).alias("avg_active_price"),
        "distinct_hosts_count",
        ratio_half_up(c("superhosts") * 100, c("distinct_hosts_count")).alias("superhost_rate"),
        ratio_half_up(c("sum_active_rating"), c("n_active_rated") * 100).alias("avg_active_rating"),
        "total_active_stays",
        F.when(c("active_ct") > 0, ratio_half_up(c("sum_rev_cents"), c("active_ct") * 100))
        .alias("avg_estimated_rev_per_active_listing"),
        pct_change_rounded(c("active_ct"), c("prev_active_ct")).alias("pct_change_active_listings"),
        pct_change_rounded(c("inactive_ct"), c("prev_inactive_ct")).alias("pct_change_inactive_listings"),
    ).orderBy("listing_neighbourhood", "month_start")


def mart_property_type(fact: DataFrame, prop_hist: DataFrame, host_hist: DataFrame, step: Step = _in_one) -> DataFrame:
    """KPIs per (property type, room type, accommodates) and month, unrounded;
    the superhost rate counts only hosts with an active listing."""
    return property_type_kpis(_latest_enriched(fact, prop_hist, host_hist, PROPERTY_KEYS, step))


PROPERTY_KEYS = ["property_type", "room_type", "accommodates"]


def property_parts(latest: DataFrame) -> DataFrame:
    """The exact ingredients of the property-type mart by group and month."""
    return _aggregate(latest, PROPERTY_KEYS + ["month_start"], active_superhost_only=True)


def property_type_kpis(latest: DataFrame) -> DataFrame:
    """The property-type mart from the monthly fact."""
    return property_from_parts(property_parts(latest))


def property_from_parts(a: DataFrame) -> DataFrame:
    """The property-type mart from its ingredients of all months."""
    keys = PROPERTY_KEYS
    w = Window.partitionBy(*keys).orderBy("month_start")
    a = (a.withColumn("prev_active_ct", F.lag("active_ct").over(w))
          .withColumn("prev_inactive_ct", F.lag("inactive_ct").over(w)))
    c = F.col
    return a.select(
        *keys, "month_start",
        exact_quotient(c("active_ct") * 100, c("total_listings_count")).alias("active_listings_rate"),
        c("min_active_price").cast("double").alias("min_active_price"),
        c("max_active_price").cast("double").alias("max_active_price"),
        (c("median_active_cents") / 100).alias("median_active_price"),
        exact_quotient(c("sum_active_cents"), c("n_active_priced") * 100).alias("avg_active_price"),
        "distinct_hosts_count",
        exact_quotient(c("superhosts") * 100, c("distinct_hosts_count")).alias("superhost_rate"),
        exact_quotient(c("sum_active_rating"), c("n_active_rated") * 100).alias("avg_active_rating"),
        "total_active_stays",
        F.when(c("active_ct") > 0, exact_quotient(c("sum_rev_cents"), c("active_ct") * 100))
        .alias("avg_estimated_rev_per_active_listing"),
        pct_change_exact(c("active_ct"), c("prev_active_ct")).alias("pct_change_active_listings"),
        pct_change_exact(c("inactive_ct"), c("prev_inactive_ct")).alias("pct_change_inactive_listings"),
    ).orderBy(*[F.col(k).asc_nulls_last() for k in keys], "month_start")


def host_area_parts(fact: DataFrame, host_hist: DataFrame, step: Step = _in_one) -> DataFrame:
    """Active listings and revenue by a host's own area, month and host, from
    the facts of the month alone.

    Per (listing, month) the most-booked scrape is kept (ties: the later one)
    with the host's area as of that scrape.  The pick depends on nights and date
    only, so it runs first (one map-side-combined aggregation) and the lookup
    sees one row per listing and month.
    """
    base = _base_fact(fact).select(
        "month_start", "host_id", "listing_id", "scraped_date", "price",
        F.when(F.col("has_availability") == "t", 1).otherwise(0).alias("is_active"),
        stays_30(F.col("availability_30")).alias("stays_in_30_days"))
    busiest = latest_per_key(base, ["listing_id", "month_start"],
                             ["stays_in_30_days", "scraped_date"])
    e = scd2.asof_join(step(busiest, "busiest"), host_hist, "host_id", "scraped_date", ["host_neighbourhood"],
                       probes=base)
    e = step(e, "with-area")
    act = F.col("is_active") == 1
    rev = (F.when(act, F.col("stays_in_30_days")).otherwise(0) * cents(F.col("price"))).cast("decimal(38,0)")
    return e.groupBy("host_neighbourhood", "month_start", "host_id").agg(
        F.sum("is_active").alias("active_ct"), F.sum(rev).alias("sum_rev_cents"))


def mart_host_neighbourhood(fact: DataFrame, host_hist: DataFrame,
                            lga_suburb: DataFrame, step: Step = _in_one) -> DataFrame:
    """Hosts and revenue per host LGA and month."""
    return host_area_from_parts(host_area_parts(fact, host_hist, step), lga_suburb)


def host_area_from_parts(parts: DataFrame, lga_suburb: DataFrame) -> DataFrame:
    """The host mart from its ingredients of all months and the present LGA map.

    An area is mapped to its LGA by lower-case name, falling back to the raw
    area; a suburb lying in several LGAs counts for the smallest name only.
    """
    lga = lga_suburb.groupBy(F.lower(F.col("suburb_name")).alias("_sub_lc")).agg(
        F.min("lga_name").alias("_lga"), F.max(F.col("lga_name").isNull()).alias("_unnamed"))
    area = F.col("host_neighbourhood")
    e = parts.join(lga, F.lower(area) == F.col("_sub_lc"), "left").withColumn(
        "host_neighbourhood_lga", F.when(F.col("_unnamed"), F.least("_lga", area)).otherwise(F.coalesce("_lga", area)))
    # hosts first, then areas: a host counts once in an LGA of several suburbs
    hosts = e.groupBy("host_neighbourhood_lga", "month_start", "host_id").agg(
        F.sum("active_ct").alias("_active"), F.sum("sum_rev_cents").alias("_rev"))
    a = hosts.groupBy("host_neighbourhood_lga", "month_start").agg(
        F.count("host_id").alias("distinct_hosts_count"),
        F.sum("_active").alias("_active"), F.sum("_rev").alias("_rev"))
    c = F.col
    return a.select(
        "host_neighbourhood_lga", "month_start", "distinct_hosts_count",
        F.when(c("_active") > 0, exact_quotient(c("_rev"), c("_active") * 100))
        .alias("estimated_revenue_per_active_listing"),
        F.when(c("distinct_hosts_count") > 0, exact_quotient(c("_rev"), c("distinct_hosts_count") * 100))
        .alias("estimated_revenue_per_host"),
    ).orderBy(F.col("host_neighbourhood_lga").asc_nulls_last(), "month_start")

