"""Silver layer: typed, defaulted copies of the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake import schemas
from lodgelake.functions import clean_price

# --- fixed values: defaults of the cleaning step ---
DEFAULT_HOST_NAME = "Unknown"
DEFAULT_HOST_SINCE = "2000-01-01"
DEFAULT_SUPERHOST = "f"
DEFAULT_HOST_AREA = "Not specified"
DEFAULT_LGA = "Unknown"
ZERO_DEFAULTS = ["availability_30", "number_of_reviews"] + schemas.REVIEW_SCORE_COLUMNS

HOST_ATTRS = ["host_name", "host_since", "host_is_superhost", "host_neighbourhood"]
PROPERTY_ATTRS = ["property_type", "room_type", "accommodates", "listing_neighbourhood"]


def silver_listings(raw: DataFrame) -> DataFrame:
    """airbnb_cleaned: defaults, numeric price; one projection, no shuffle.
    Of a raw table that was made with some of the columns, just these."""
    c = F.col
    out = []
    for name in (n for n in schemas.LISTING_COLUMNS if n in raw.columns):
        if name == "scraped_date":
            e = c(name).cast("date")
        elif name == "host_name":
            e = F.coalesce(c(name), F.lit(DEFAULT_HOST_NAME))
        elif name == "host_since":
            e = F.coalesce(c(name).cast("date"), F.lit(DEFAULT_HOST_SINCE).cast("date"))
        elif name == "host_is_superhost":
            e = F.coalesce(c(name), F.lit(DEFAULT_SUPERHOST))
        elif name == "host_neighbourhood":
            e = F.coalesce(c(name), F.lit(DEFAULT_HOST_AREA))
        elif name == "price":
            e = clean_price(c(name))
        elif name in ZERO_DEFAULTS:
            e = F.coalesce(c(name), F.lit(0).cast(raw.schema[name].dataType))
        else:
            e = c(name)
        out.append(e.alias(name))
    return raw.select(*out)


def silver_census_g01(g01: DataFrame) -> DataFrame:
    """Counts default to 0; the three totals stay as they are (NULL possible)."""
    return g01.select(
        "lga_code_2016", *schemas.G01_TOTALS,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in schemas.G01_COUNTS])


def silver_census_g02(g02: DataFrame) -> DataFrame:
    """All medians/averages default to 0 (so a missing mortgage reads as 0)."""
    return g02.select("lga_code_2016", *[
        F.coalesce(F.col(c), F.lit(0).cast(g02.schema[c].dataType)).alias(c)
        for c in schemas.G02_MEASURES])


def silver_lga_code(codes: DataFrame) -> DataFrame:
    return codes.where(F.col("lga_code").isNotNull()).select("lga_code", "lga_name")


def silver_lga_suburb(suburbs: DataFrame) -> DataFrame:
    return suburbs.select("suburb_name",
                          F.coalesce(F.col("lga_name"), F.lit(DEFAULT_LGA)).alias("lga_name"))


def silver_dim_host(cleaned: DataFrame) -> DataFrame:
    """Distinct host attributes per scrape date (input of the host history)."""
    return cleaned.select("host_id", *HOST_ATTRS, "scraped_date").distinct()


def silver_dim_property(cleaned: DataFrame) -> DataFrame:
    """Distinct listing attributes and price per scrape date."""
    return cleaned.select("listing_id", "property_type", "room_type", "accommodates",
                          "listing_neighbourhood", "price", "scraped_date").distinct()
