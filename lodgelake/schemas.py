"""Declared schemas of the raw (bronze) tables.

CSV files are read with every column as a string and then cast to these types,
so a malformed value becomes NULL (and is counted) instead of failing a job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names of the listing snapshot files, in file order ---
LISTING_COLUMNS = [
    "listing_id", "scrape_id", "scraped_date", "host_id", "host_name", "host_since",
    "host_is_superhost", "host_neighbourhood", "listing_neighbourhood", "property_type",
    "room_type", "accommodates", "price", "has_availability", "availability_30",
    "number_of_reviews", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_value",
]

REVIEW_SCORE_COLUMNS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]

AIRBNB_RAW = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("scrape_id", T.LongType()),
    T.StructField("scraped_date", T.DateType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("host_name", T.StringType()),
    T.StructField("host_since", T.DateType()),
    T.StructField("host_is_superhost", T.StringType()),
    T.StructField("host_neighbourhood", T.StringType()),
    T.StructField("listing_neighbourhood", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("accommodates", T.IntegerType()),
    T.StructField("price", T.StringType()),          # text in bronze: may hold '$' and ','
    T.StructField("has_availability", T.StringType()),
    T.StructField("availability_30", T.IntegerType()),
    T.StructField("number_of_reviews", T.IntegerType()),
] + [T.StructField(c, T.DecimalType(5, 2)) for c in REVIEW_SCORE_COLUMNS])

# --- fixed values: the 36 census G01 measures, each reported for m, f and p ---
G01_MEASURES = [
    "tot_p",
    "age_0_4_yr", "age_5_14_yr", "age_15_19_yr", "age_20_24_yr", "age_25_34_yr",
    "age_35_44_yr", "age_45_54_yr", "age_55_64_yr", "age_65_74_yr", "age_75_84_yr",
    "age_85ov",
    "counted_census_night_home", "count_census_nt_ewhere_aust",
    "indigenous_psns_aboriginal", "indig_psns_torres_strait_is",
    "indig_bth_abor_torres_st_is", "indigenous_p_tot",
    "birthplace_australia", "birthplace_elsewhere",
    "lang_spoken_home_eng_only", "lang_spoken_home_oth_lang",
    "australian_citizen",
    "age_psns_att_educ_inst_0_4", "age_psns_att_educ_inst_5_14",
    "age_psns_att_edu_inst_15_19", "age_psns_att_edu_inst_20_24",
    "age_psns_att_edu_inst_25_ov",
    "high_yr_schl_comp_yr_12_eq", "high_yr_schl_comp_yr_11_eq",
    "high_yr_schl_comp_yr_10_eq", "high_yr_schl_comp_yr_9_eq",
    "high_yr_schl_comp_yr_8_belw", "high_yr_schl_comp_d_n_g_sch",
    "count_psns_occ_priv_dwgs", "count_persons_other_dwgs",
]
SEXES = ["m", "f", "p"]

# --- fixed values: the eleven age bands used for demographic shares ---
AGE_BANDS = [
    ("age_0_4_yr", "pct_age_0_4"), ("age_5_14_yr", "pct_age_5_14"),
    ("age_15_19_yr", "pct_age_15_19"), ("age_20_24_yr", "pct_age_20_24"),
    ("age_25_34_yr", "pct_age_25_34"), ("age_35_44_yr", "pct_age_35_44"),
    ("age_45_54_yr", "pct_age_45_54"), ("age_55_64_yr", "pct_age_55_64"),
    ("age_65_74_yr", "pct_age_65_74"), ("age_75_84_yr", "pct_age_75_84"),
    ("age_85ov", "pct_age_85_plus"),
]

G01_COLUMNS = ["lga_code_2016"] + [f"{m}_{s}" for m in G01_MEASURES for s in SEXES]
G01_TOTALS = [f"tot_p_{s}" for s in SEXES]
G01_COUNTS = [c for c in G01_COLUMNS[1:] if c not in G01_TOTALS]

CENSUS_G01 = T.StructType(
    [T.StructField("lga_code_2016", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in G01_COLUMNS[1:]]
)

CENSUS_G02 = T.StructType([
    T.StructField("lga_code_2016", T.StringType()),
    T.StructField("median_age_persons", T.IntegerType()),
    T.StructField("median_mortgage_repay_monthly", T.IntegerType()),
    T.StructField("median_tot_prsnl_inc_weekly", T.IntegerType()),
    T.StructField("median_rent_weekly", T.IntegerType()),
    T.StructField("median_tot_fam_inc_weekly", T.IntegerType()),
    T.StructField("average_num_psns_per_bedroom", T.DecimalType(6, 3)),
    T.StructField("median_tot_hhd_inc_weekly", T.IntegerType()),
    T.StructField("average_household_size", T.DecimalType(6, 3)),
])
G02_MEASURES = [f.name for f in CENSUS_G02.fields[1:]]

LGA_SUBURB = T.StructType([
    T.StructField("lga_name", T.StringType()),
    T.StructField("suburb_name", T.StringType()),
])

LGA_CODE = T.StructType([
    T.StructField("lga_code", T.StringType()),
    T.StructField("lga_name", T.StringType()),
])

BRONZE = {
    "airbnb_raw": AIRBNB_RAW,
    "census_g01": CENSUS_G01,
    "census_g02": CENSUS_G02,
    "nsw_lga_suburb": LGA_SUBURB,
    "nsw_lga_code": LGA_CODE,
}


def all_string(schema: T.StructType) -> T.StructType:
    """Same field names, every type string: the CSV read schema."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
