"""DuckDB SQL of the analyses and marts, one copy of each chain.

Written from the description of each result, with DuckDB's own means
(``arg_max`` of a packed snapshot, ``ASOF JOIN``, ``QUALIFY``, ``FILTER``), so
that it is a witness independent of the Spark plans.  Names in here are local;
only output columns are shared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from lodgelake import schemas
from lodgelake.plans.oracle_sql import asof, cents, digits, initcap, quotient, ratio, stays, stays_clamped, with_base

_NIGHTS = stays_clamped("availability_30")
_CENTS = f"CAST({cents('price')} AS HUGEINT)"
_MONTH = "CAST(date_trunc('month', scraped_date) AS DATE)"

#: The last twelve months, every snapshot packed into one value.
RECENT = f"""
span AS (SELECT max(scraped_date) AS newest, max(scraped_date) - INTERVAL 12 MONTH AS oldest FROM airbnb_cleaned),
snap AS (
  SELECT listing_id, scraped_date, {_MONTH} AS month_start,
    struct_pack(host := host_id, hood := lower(trim(listing_neighbourhood)), nights := {_NIGHTS}, c := {_CENTS}) AS s
  FROM airbnb_cleaned, span WHERE scraped_date >= oldest
)"""

#: Areas by what their listings earned in the last twelve months.
AREAS = RECENT + f""",
area_month AS (
  SELECT listing_id, month_start, lga_code_key, lga_name, s.nights AS stays_30,
    CAST(coalesce(s.c, 0) * s.nights AS DECIMAL(38,0)) AS rev_c
  FROM (SELECT listing_id, month_start, arg_max(s, scraped_date) AS s FROM snap GROUP BY ALL)
  JOIN place ON place.suburb_key = s.hood AND lga_code_key IS NOT NULL
),
area_listing AS (
  SELECT listing_id, lga_code_key, lga_name, CAST(sum(stays_30) AS BIGINT) AS stays_12m,
    CAST(sum(rev_c) AS DECIMAL(38,0)) AS rev_12m_c
  FROM area_month GROUP BY ALL HAVING stays_12m > 0
),
area_score AS (
  SELECT lga_code_key, lga_name, count(*) AS active_listings,
    {quotient("sum(rev_12m_c)", "count(*) * 100")} AS avg_rev_per_active_listing
  FROM area_listing GROUP BY lga_code_key, lga_name
),
area_ends AS (
  SELECT *, row_number() OVER (ORDER BY avg_rev_per_active_listing DESC NULLS LAST, lga_code_key, lga_name) AS best,
    row_number() OVER (ORDER BY avg_rev_per_active_listing ASC NULLS LAST, lga_code_key, lga_name) AS worst
  FROM area_score
),
area_tagged AS (
  SELECT grp, area_ends.* EXCLUDE (best, worst)
  FROM area_ends JOIN (VALUES ('top3'), ('bottom3')) AS side(grp)
    ON CASE grp WHEN 'top3' THEN best ELSE worst END <= 3
)"""
TOP_AREAS = "SELECT * EXCLUDE (best, worst) FROM area_ends WHERE best <= 3"
BOTTOM_AREAS = "SELECT * EXCLUDE (best, worst) FROM area_ends WHERE worst <= 3"

#: Household size and age shares of each area.
PEOPLE = f"""
people AS (
  SELECT {digits("lga_code_2016")} AS lga_code_key,
    {", ".join(f"{quotient(f'{m}_p', 'tot_p_p')} AS {name}" for m, name in schemas.AGE_BANDS)}
  FROM census_g01_cleaned
),
census_demo AS (
  SELECT people.*, CAST(g.average_household_size AS DOUBLE) AS average_household_size
  FROM people JOIN census_g02_cleaned g ON {digits("g.lga_code_2016")} = people.lga_code_key
)"""

#: Suburbs by revenue, and their people's age.
HOODS = f"""
hood_score AS (
  SELECT suburb_key, {quotient("sum(c)", "count(*) * 100")} AS revenue_per_active_listing
  FROM (SELECT listing_id, lower(trim(listing_neighbourhood)) AS suburb_key, sum({_NIGHTS}) AS n,
          sum(coalesce({_CENTS}, 0) * {_NIGHTS}) AS c
        FROM airbnb_cleaned WHERE listing_neighbourhood <> '' GROUP BY ALL)
  WHERE n > 0 GROUP BY suburb_key
),
hood_age AS (
  SELECT suburb_key, {quotient("sum(age)", "count(age)")} AS median_age
  FROM (SELECT DISTINCT suburb_key, lga_code_key FROM place)
  JOIN (SELECT {digits("lga_code_2016")} AS lga_code_key, median_age_persons AS age FROM census_g02_cleaned)
    USING (lga_code_key)
  GROUP BY suburb_key
),
hood_pair AS (
  SELECT * FROM hood_score JOIN hood_age USING (suburb_key)
  WHERE revenue_per_active_listing IS NOT NULL AND median_age IS NOT NULL
)"""

#: Kinds of listing by nights, and the five best-earning suburbs.
KINDS = f"""
kind AS (
  SELECT listing_id, lower(trim(listing_neighbourhood)) AS suburb_key, property_type, room_type, accommodates,
    CAST(sum({_NIGHTS}) AS BIGINT) AS total_stays, CAST(sum({_CENTS} * {_NIGHTS}) AS DECIMAL(38,0)) AS rev_c
  FROM airbnb_cleaned GROUP BY ALL HAVING total_stays > 0
),
hood_top AS (
  SELECT suburb_key FROM kind GROUP BY suburb_key
  QUALIFY row_number() OVER (
    ORDER BY {quotient("sum(rev_c)", "count(rev_c) * 100")} DESC NULLS LAST, suburb_key NULLS LAST) <= 5
),
kind_best AS (
  SELECT suburb_key, property_type, room_type, accommodates, CAST(sum(total_stays) AS BIGINT) AS total_stays
  FROM kind GROUP BY suburb_key, property_type, room_type, accommodates
  QUALIFY row_number() OVER (PARTITION BY suburb_key ORDER BY sum(total_stays) DESC,
    property_type NULLS LAST, room_type NULLS LAST, accommodates NULLS LAST) = 1
)"""

#: Listings with their latest owner and place.
HOMES = """
home AS (
  SELECT listing_id,
    arg_max(struct_pack(host := host_id, hood := lower(trim(listing_neighbourhood))), scraped_date) AS s
  FROM airbnb_cleaned GROUP BY listing_id
)"""

#: Owners of one listing: a year's revenue against a year's mortgage.
COVERAGE = RECENT + "," + HOMES + f""",
single AS (SELECT s.host AS host_id FROM home GROUP BY s.host HAVING count(*) = 1),
host_month AS (
  SELECT listing_id, s.host AS host_id, month_start, lga_name, lga_code_key, s.nights AS n,
    coalesce(s.c, 0) * s.nights AS c
  FROM (SELECT listing_id, month_start, arg_max(s, scraped_date) AS s FROM snap WHERE s.hood <> '' GROUP BY ALL)
  JOIN (SELECT DISTINCT suburb_key, lga_name, lga_code_key FROM place) AS area ON area.suburb_key = s.hood
),
earned AS (
  SELECT listing_id, host_id, CAST(sum(c) AS DECIMAL(38,0)) AS rev_12m_c
  FROM host_month GROUP BY listing_id, host_id HAVING sum(n) > 0
),
seat AS (
  SELECT listing_id, first(struct_pack(name := lga_name, code := lga_code_key)
    ORDER BY month_start DESC, lga_code_key NULLS LAST, lga_name NULLS LAST) AS spot
  FROM host_month GROUP BY listing_id
),
cover AS (
  SELECT host_id, listing_id, spot.name AS lga_name, spot.code AS lga_code_key, rev_12m_c, pay,
    CASE WHEN rev_12m_c >= CAST(pay AS HUGEINT) * 1200 THEN 1 ELSE 0 END AS covers_flag
  FROM earned JOIN single USING (host_id) JOIN seat USING (listing_id)
  JOIN (SELECT {digits("lga_code_2016")} AS code, median_mortgage_repay_monthly AS pay FROM census_g02_cleaned) AS g
    ON g.code = spot.code
  WHERE pay IS NOT NULL
)"""


def _listing_mart(keys: Sequence[str], key_of: str, divide: Callable[[str, str], str], median: str, superhost: str) -> str:
    """KPIs per key and month over each listing's last snapshot of the month."""
    names = ", ".join(keys)
    c = cents("price")
    return with_base(f"""
SELECT {names}, month_start,{" strftime(month_start, '%Y-%m') AS month_year," if len(keys) == 1 else ""}
  {divide("100 * opened", "opened + closed")} AS active_listings_rate,
  CAST(low AS DOUBLE) AS min_active_price, CAST(high AS DOUBLE) AS max_active_price,
  {median} AS median_active_price, {divide("price_c", "priced * 100")} AS avg_active_price,
  hosts AS distinct_hosts_count, {divide("100 * superhosts", "hosts")} AS superhost_rate,
  {divide("rating_c", "rated * 100")} AS avg_active_rating, nights AS total_active_stays,
  {divide("revenue_c", "opened * 100")} AS avg_estimated_rev_per_active_listing,
  {divide("100 * (opened - lag(opened) OVER before)", "lag(opened) OVER before")} AS pct_change_active_listings,
  {divide("100 * (closed - lag(closed) OVER before)", "lag(closed) OVER before")} AS pct_change_inactive_listings
FROM kpi WINDOW before AS (PARTITION BY {names} ORDER BY month_start)
ORDER BY {names}, month_start""", f"""
closing AS (
  SELECT f.*, CAST(date_trunc('month', f.scraped_date) AS DATE) AS month_start, {key_of},
    coalesce(f.has_availability = 't', false) AS open, {stays("f.availability_30")} AS stay, h.host_is_superhost
  FROM fact_listings f
  {asof("a", "property_snapshot", "listing_id")}
  {asof("h", "host_snapshot", "host_id")}
  QUALIFY row_number() OVER (PARTITION BY f.listing_id, date_trunc('month', f.scraped_date)
    ORDER BY f.scraped_date DESC) = 1
),
kpi AS (
  SELECT {names}, month_start, count(*) FILTER (open) AS opened, count(*) FILTER (NOT open) AS closed,
    min(price) FILTER (open) AS low, max(price) FILTER (open) AS high,
    quantile_cont({c}, 0.5) FILTER (open) AS mid_c, sum({c}) FILTER (open) AS price_c,
    count(price) FILTER (open) AS priced, count(DISTINCT host_id) AS hosts,
    count(DISTINCT host_id) FILTER ({superhost}) AS superhosts,
    sum(CAST(review_scores_rating * 100 AS BIGINT)) FILTER (open) AS rating_c,
    count(review_scores_rating) FILTER (open) AS rated,
    CAST(sum(CAST(open AS INTEGER) * stay) AS BIGINT) AS nights,
    sum(CAST(open AS INTEGER) * stay * {c}) AS revenue_c
  FROM closing GROUP BY {names}, month_start
)""")


LISTING_MART = _listing_mart(
    ["listing_neighbourhood"], "coalesce(a.listing_neighbourhood, 'Unknown') AS listing_neighbourhood",
    ratio, "CAST(floor(mid_c + 0.5) AS DOUBLE) / 100", "host_is_superhost = 't'")
PROPERTY_MART = _listing_mart(
    ["property_type", "room_type", "accommodates"], "a.property_type, a.room_type, a.accommodates",
    quotient, "mid_c / 100", "open AND host_is_superhost = 't'")

HOST_MART = with_base(f"""
SELECT host_neighbourhood_lga, month_start, count(DISTINCT host_id) AS distinct_hosts_count,
  {quotient("sum(open * stay * c)", "sum(open) * 100")} AS estimated_revenue_per_active_listing,
  {quotient("sum(open * stay * c)", "count(DISTINCT host_id) * 100")} AS estimated_revenue_per_host
FROM busiest GROUP BY host_neighbourhood_lga, month_start ORDER BY ALL""", f"""
busiest AS (
  SELECT f.host_id, CAST(date_trunc('month', f.scraped_date) AS DATE) AS month_start,
    coalesce(area.lga_name, h.host_neighbourhood) AS host_neighbourhood_lga,
    CASE WHEN f.has_availability = 't' THEN 1 ELSE 0 END AS open, {stays("f.availability_30")} AS stay, {cents("f.price")} AS c
  FROM fact_listings f
  {asof("h", "host_snapshot", "host_id")}
  LEFT JOIN lga_suburb_cleaned area ON lower(area.suburb_name) = lower(h.host_neighbourhood)
  QUALIFY row_number() OVER (PARTITION BY f.listing_id, date_trunc('month', f.scraped_date)
    ORDER BY stay DESC, f.scraped_date DESC, host_neighbourhood_lga NULLS LAST) = 1
)""")

TOP_BOTTOM = with_base(f"""
SELECT grp, t.lga_code_key AS lga_code, t.lga_name, t.active_listings, t.avg_rev_per_active_listing,
  d.* EXCLUDE (lga_code_key)
FROM area_tagged t LEFT JOIN census_demo d USING (lga_code_key)
ORDER BY grp DESC, t.avg_rev_per_active_listing DESC""", AREAS.strip(), PEOPLE.strip())

AGE_REVENUE = with_base(f"""
SELECT {initcap("suburb_key")} AS listing_neighbourhood, median_age, revenue_per_active_listing
FROM hood_pair ORDER BY revenue_per_active_listing DESC""", HOODS.strip())

AGE_CORRELATION = with_base("""
SELECT n_pairs, sign(r) * floor(abs(r) * 1000000000.0 + 0.5) / 1000000000.0 AS corr_age_revenue
FROM (SELECT count(*) AS n_pairs, corr(median_age, revenue_per_active_listing) AS r FROM hood_pair)""", HOODS.strip())

BEST_KIND = with_base(f"""
SELECT {initcap("suburb_key")} AS listing_neighbourhood, property_type, room_type, accommodates, total_stays
FROM kind_best SEMI JOIN hood_top USING (suburb_key) ORDER BY total_stays DESC""", KINDS.strip())

CONCENTRATION = with_base("""
SELECT if(areas = 1, 'Concentrated in one LGA', 'Distributed across multiple LGAs') AS distribution_type,
  count(*) AS num_hosts
FROM (SELECT s.host, count(DISTINCT listing_id) AS homes, count(DISTINCT lga_code_key) AS areas
      FROM home JOIN place ON place.suburb_key = s.hood AND lga_code_key IS NOT NULL GROUP BY s.host)
WHERE homes > 1 GROUP BY ALL ORDER BY ALL""", HOMES.strip())

MORTGAGE = with_base(f"""
SELECT lga_name, count(*) AS total_single_listing_hosts, CAST(sum(covers_flag) AS BIGINT) AS hosts_covering_mortgage,
  {ratio("100 * sum(covers_flag)", "count(*)")} AS coverage_percentage
FROM cover GROUP BY lga_name ORDER BY coverage_percentage DESC NULLS LAST, lga_name""", COVERAGE.strip())
