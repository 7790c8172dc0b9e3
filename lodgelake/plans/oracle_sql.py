"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

They run over the driver's pre-registered views (lineitem, orders, ...).  The
shared CTEs below restate the table mapping and the cleaning rules in plain
SQL; each query appends its own CTEs and final SELECT.  Conventions shared with
the Spark side: money in integer cents, rounded figures via exact integer
half-up rounding, unrounded ratios as one DOUBLE division.
"""

from __future__ import annotations

from lodgelake import schemas

SCORES = schemas.REVIEW_SCORE_COLUMNS


def ratio(num: str, den: str, scale: int = 2) -> str:
    """round(num/den, scale) half away from zero, exact, as DOUBLE."""
    k = 10 ** scale
    n = f"(CAST({num} AS HUGEINT) * {k})"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} > 0 THEN CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) "
            f"AS DOUBLE) / {k} END)")


def quotient(num: str, den: str) -> str:
    """One DOUBLE division of exact operands, NULL on a zero denominator."""
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


def cents(price: str) -> str:
    return f"CAST({price} * 100 AS BIGINT)"


def initcap(s: str) -> str:
    return (f"(CASE WHEN {s} IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all(lower({s}), '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)'), "
            f"lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '') END)")


def stays(a: str) -> str:
    return f"greatest(0, 30 - coalesce({a}, 0))"


def stays_clamped(a: str) -> str:
    return f"greatest(0, least(30, 30 - coalesce({a}, 0)))"


def digits(s: str) -> str:
    return f"regexp_replace(CAST({s} AS VARCHAR), '[^0-9]', '', 'g')"


_score_nulls = ",\n    ".join(f"CAST(NULL AS DECIMAL(5,2)) AS {c}" for c in SCORES[1:])
_score_zero = ",\n    ".join(f"CAST(coalesce({c}, 0) AS DECIMAL(5,2)) AS {c}" for c in SCORES)

MAPPED = f"""
mapped AS (
  SELECT
    l.l_partkey AS listing_id,
    CAST(NULL AS BIGINT) AS scrape_id,
    CAST(l.l_shipdate AS DATE) AS scraped_date,
    o.o_custkey AS host_id,
    CASE l.l_linenumber WHEN 3 THEN c.c_name || ' "Jr", x' WHEN 4 THEN c.c_name || chr(10) || '2' ELSE c.c_name END AS host_name,
    CASE WHEN l.l_linenumber <> 1 THEN CAST(o.o_orderdate AS DATE) END AS host_since,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 't'
         WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE 'f' END AS host_is_superhost,
    hn.n_name AS host_neighbourhood,
    CASE WHEN l.l_linenumber = 5 AND l.l_suppkey % 3 = 0 THEN NULL WHEN l.l_linenumber = 5 AND l.l_suppkey % 3 = 1 THEN ' '
         WHEN l.l_linenumber = 6 THEN '  ' || lower(ln.n_name) || ' ' ELSE ln.n_name END AS listing_neighbourhood,
    p.p_type AS property_type,
    split_part(p.p_name, ' ', 2) AS room_type,
    CAST(p.p_size % 8 + 1 AS INTEGER) AS accommodates,
    '$' || format('{{:,.2f}}', CAST(l.l_extendedprice AS DECIMAL(18,2))) AS price,
    CASE WHEN l.l_returnflag = 'R' THEN 'f' ELSE 't' END AS has_availability,
    CASE WHEN l.l_linenumber <> 7 THEN CAST(l.l_quantity AS INTEGER) END AS availability_30,
    CAST(l.l_linenumber AS INTEGER) AS number_of_reviews,
    CAST(l.l_discount * 1000 AS DECIMAL(5,2)) AS review_scores_rating,
    {_score_nulls},
    l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation hn ON hn.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation ln ON ln.n_nationkey = s.s_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey
),
ranked_load AS (
  SELECT *, row_number() OVER (PARTITION BY listing_id, scraped_date
      ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS load_rank
  FROM mapped
),
airbnb_raw AS (
  SELECT {", ".join(schemas.LISTING_COLUMNS)} FROM ranked_load WHERE load_rank = 1
),
airbnb_cleaned AS (
  SELECT listing_id, scrape_id, scraped_date, host_id,
    coalesce(host_name, 'Unknown') AS host_name,
    coalesce(host_since, DATE '2000-01-01') AS host_since,
    coalesce(host_is_superhost, 'f') AS host_is_superhost,
    coalesce(host_neighbourhood, 'Not specified') AS host_neighbourhood,
    listing_neighbourhood, property_type, room_type, accommodates,
    TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DECIMAL(18,2)) AS price,
    has_availability,
    coalesce(availability_30, 0) AS availability_30,
    coalesce(number_of_reviews, 0) AS number_of_reviews,
    {_score_zero}
  FROM airbnb_raw
)"""

_band_cols = []
for _b, (_m, _) in enumerate(schemas.AGE_BANDS):
    _band_cols += [
        f"CAST(count_if(band = {_b} AND sex = 0) AS INTEGER) AS {_m}_m",
        f"CAST(count_if(band = {_b} AND sex = 1) AS INTEGER) AS {_m}_f",
        f"CAST(count_if(band = {_b}) AS INTEGER) AS {_m}_p",
    ]
_g01_known = {"lga_code_2016", "tot_p_m", "tot_p_f", "tot_p_p"} | {
    f"{m}_{s}" for m, _ in schemas.AGE_BANDS for s in schemas.SEXES}
_g01_select = ", ".join(
    c if c in _g01_known else f"CAST(NULL AS INTEGER) AS {c}" for c in schemas.G01_COLUMNS)
_g01_clean = ", ".join(["lga_code_2016"] + schemas.G01_TOTALS + [
    f"coalesce({c}, 0) AS {c}" for c in schemas.G01_COUNTS])
_g02_types = {f.name: f.dataType.simpleString().upper() for f in schemas.CENSUS_G02.fields}
_g02_clean = ", ".join(["lga_code_2016"] + [
    f"CAST(coalesce({c}, 0) AS {_g02_types[c]}) AS {c}" for c in schemas.G02_MEASURES])

CENSUS = f"""
regions AS (
  SELECT r_regionkey, r_name AS lga_name, CAST(10000 + r_regionkey AS VARCHAR) AS lga_code
  FROM region
),
nsw_lga_code AS (
  SELECT lga_code, lga_name FROM regions
  UNION ALL SELECT NULL, lga_name || ' OLD' FROM regions WHERE r_regionkey = 0
),
nsw_lga_suburb AS (
  SELECT CASE WHEN n_nationkey <> 2 THEN r_name END AS lga_name, n_name AS suburb_name
  FROM (SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey <> 3
        UNION ALL SELECT n_nationkey, n_name, (n_regionkey + 1) % 5 FROM nation WHERE n_nationkey = 5) n
  JOIN region ON n.n_regionkey = r_regionkey
),
lga_code_cleaned AS (SELECT lga_code, lga_name FROM nsw_lga_code WHERE lga_code IS NOT NULL),
lga_suburb_cleaned AS (
  SELECT suburb_name, coalesce(lga_name, 'Unknown') AS lga_name FROM nsw_lga_suburb
),
census_g02 AS (
  SELECT 'LGA' || lga_code AS lga_code_2016,
    CAST(30 + 3 * r_regionkey AS INTEGER) AS median_age_persons,
    CAST(60000 + 15000 * r_regionkey AS INTEGER) AS median_mortgage_repay_monthly,
    CAST(NULL AS INTEGER) AS median_tot_prsnl_inc_weekly,
    CAST(NULL AS INTEGER) AS median_rent_weekly,
    CAST(NULL AS INTEGER) AS median_tot_fam_inc_weekly,
    CAST(NULL AS DECIMAL(6,3)) AS average_num_psns_per_bedroom,
    CAST(NULL AS INTEGER) AS median_tot_hhd_inc_weekly,
    CAST(2.0 + 0.2 * r_regionkey AS DECIMAL(6,3)) AS average_household_size
  FROM regions
),
cust_band AS (
  SELECT n.n_regionkey AS r_regionkey,
    CAST(least(10, greatest(0, floor((c.c_acctbal + 1000) / 1000))) AS INTEGER) AS band,
    c.c_custkey % 2 AS sex
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
),
g01_counts AS (
  SELECT 'LGA' || rg.lga_code AS lga_code_2016,
    CAST(count_if(sex = 0) AS INTEGER) AS tot_p_m,
    CAST(count_if(sex = 1) AS INTEGER) AS tot_p_f,
    CAST(count(*) AS INTEGER) AS tot_p_p,
    {", ".join(_band_cols)}
  FROM cust_band cb JOIN regions rg ON rg.r_regionkey = cb.r_regionkey
  GROUP BY rg.lga_code
),
census_g01 AS (SELECT {_g01_select} FROM g01_counts),
census_g01_cleaned AS (SELECT {_g01_clean} FROM census_g01),
census_g02_cleaned AS (SELECT {_g02_clean} FROM census_g02)"""


def _history(name: str, src: str, key: str, attrs: list[str]) -> str:
    order = ", ".join(f"{a} DESC NULLS LAST" for a in attrs)
    cols = ", ".join(attrs)
    return f"""
{name}_one AS (
  SELECT {key}, {cols}, scraped_date, CAST(scraped_date AS TIMESTAMP) AS updated_at,
    row_number() OVER (PARTITION BY {key}, scraped_date ORDER BY {order}) AS version_rank
  FROM {src}
),
{name} AS (
  SELECT {key}, {cols}, scraped_date, updated_at, updated_at AS valid_from,
    lead(updated_at) OVER (PARTITION BY {key} ORDER BY updated_at) AS valid_to
  FROM {name}_one WHERE version_rank = 1
)"""


HOST_ATTRS = ["host_name", "host_since", "host_is_superhost", "host_neighbourhood"]
PROP_ATTRS = ["property_type", "room_type", "accommodates", "listing_neighbourhood"]

STAR = f"""
dim_host AS (
  SELECT DISTINCT host_id, host_name, host_since, host_is_superhost, host_neighbourhood,
    scraped_date FROM airbnb_cleaned
),
dim_property AS (
  SELECT DISTINCT listing_id, property_type, room_type, accommodates, listing_neighbourhood,
    price, scraped_date FROM airbnb_cleaned
),{_history("host_snapshot", "dim_host", "host_id", HOST_ATTRS)},{
_history("property_snapshot", "dim_property", "listing_id", PROP_ATTRS)},
fact_listings AS (
  SELECT listing_id, host_id, scraped_date, price, number_of_reviews, review_scores_rating,
    has_availability, availability_30 FROM airbnb_cleaned
),
place AS (
  SELECT lower(trim(suburb_name)) AS suburb_key, lga_name, lga_code AS lga_code_raw, {digits("lga_code")} AS lga_code_key
  FROM lga_code_cleaned
  JOIN (SELECT suburb_name, lower(trim(lga_name)) AS area FROM lga_suburb_cleaned) ON area = lower(trim(lga_name))
  GROUP BY ALL
)"""

BASE = MAPPED + "," + CENSUS + "," + STAR


def with_base(body: str, *ctes: str) -> str:
    """Prefix the shared CTEs (plus extra named CTEs) to a final SELECT."""
    extra = "".join("," + c for c in ctes)
    return f"WITH {BASE}{extra}\n{body}"


def asof(alias: str, table: str, key: str, fact: str = "f") -> str:
    """The version in force at a fact's date; versions of a key follow each
    other without gaps, so it is the last one that has begun."""
    return (f"ASOF LEFT JOIN {table} {alias} ON {fact}.{key} = {alias}.{key} "
            f"AND CAST({fact}.scraped_date AS TIMESTAMP) >= {alias}.valid_from")
