"""History tables and the star schema (fact + current dimensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.operators import scd2
from lodgelake.plans.silver import HOST_ATTRS, PROPERTY_ATTRS

FACT_COLUMNS = ["listing_id", "host_id", "scraped_date", "price", "number_of_reviews",
                "review_scores_rating", "has_availability", "availability_30"]

# listing columns that the histories are made of
HOST_ROWS = ["host_id", *HOST_ATTRS, "scraped_date"]
PROPERTY_ROWS = ["listing_id", *PROPERTY_ATTRS, "scraped_date"]


def with_updated_at(dim: DataFrame) -> DataFrame:
    """Version time = scrape date at midnight (time-zone free)."""
    return dim.withColumn("updated_at", F.col("scraped_date").cast("timestamp_ntz"))


def host_history(listings: DataFrame) -> DataFrame:
    """From the listings, or their distinct host rows: the history keeps one
    attribute set per host and date either way."""
    rows = listings.select("host_id", *HOST_ATTRS, "scraped_date")
    return scd2.build_history(with_updated_at(rows), "host_id", HOST_ATTRS)


def property_history(listings: DataFrame) -> DataFrame:
    """As ``host_history``; price is not a tracked attribute."""
    rows = listings.select("listing_id", *PROPERTY_ATTRS, "scraped_date")
    return scd2.build_history(with_updated_at(rows), "listing_id", PROPERTY_ATTRS)


def fact_listings(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*FACT_COLUMNS)


def dim_host_current(host_hist: DataFrame) -> DataFrame:
    return scd2.current(host_hist).select("host_id", *HOST_ATTRS)


def dim_listing(prop_hist: DataFrame) -> DataFrame:
    return scd2.current(prop_hist).select("listing_id", *PROPERTY_ATTRS)


def dim_suburb(lga_suburb: DataFrame) -> DataFrame:
    return lga_suburb.select("suburb_name", "lga_name")


def dim_lga(lga_code: DataFrame) -> DataFrame:
    return lga_code.select("lga_code", "lga_name")
