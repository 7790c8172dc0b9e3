"""Edge cases of FIXTURES.md section A on literal frames, and survey section 5
properties on the driver tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lodgelake import schemas
from lodgelake.plans import analysis, marts, silver
from lodgelake.plans.layers import Layers

D = dt.date


def listings(spark, rows):
    """Silver listing rows from (listing_id, date, host_id, area, price, availability, active)."""
    raw = spark.createDataFrame(
        [(lid, d, hid, area, price, avail, "t" if act else "f") for lid, d, hid, area, price, avail, act in rows],
        "listing_id long, scraped_date date, host_id long, listing_neighbourhood string, "
        "price string, availability_30 int, has_availability string")
    for f in schemas.AIRBNB_RAW.fields:
        if f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit(None).cast(f.dataType))
    return silver.silver_listings(raw.select(*schemas.LISTING_COLUMNS))


def areas(spark):
    sub = spark.createDataFrame(
        [("North", "Alpha"), ("North", " o'connor "), ("South", "O'CONNOR"), ("South", "Beta"),
         (None, "Lost")], "lga_name string, suburb_name string")
    code = spark.createDataFrame([("LGA10050", "north"), ("10060", " South ")],
                                 "lga_code string, lga_name string")
    return silver.silver_lga_suburb(sub), silver.silver_lga_code(code)


def test_suburb_areas_normalises_and_fans_out(spark):
    sub, code = areas(spark)
    got = sorted((r.suburb_key, r.lga_code_key)
                 for r in analysis.suburb_areas(sub, code).collect())
    # padded / mixed case names match; o'connor lies in two LGAs; 'Lost' has no LGA code
    assert got == [("alpha", "10050"), ("beta", "10060"), ("o'connor", "10050"), ("o'connor", "10060")]


def test_host_concentration_counts_fan_out_as_spread(spark):
    sub, code = areas(spark)
    d = D(2020, 1, 1)
    rows = [(1, d, 100, "Alpha", "$10", 5, 1), (2, d, 100, "alpha ", "$10", 5, 1),      # one LGA
            (3, d, 200, "O'Connor", "$10", 5, 1), (4, d, 200, "Alpha", "$10", 5, 1),    # fan-out
            (5, d, 300, "Beta", "$10", 5, 1),                                           # one listing
            (6, d, 400, "Nowhere", "$10", 5, 1), (7, d, 400, None, "$10", 5, 1)]        # unmapped
    got = {r.distribution_type: r.num_hosts
           for r in analysis.host_concentration(listings(spark, rows), sub, code).collect()}
    assert got == {analysis.CONCENTRATED: 1, analysis.DISTRIBUTED: 1}


def month_rows(spark, rows):
    """Monthly fact rows: (listing, month, host, area, price, availability, active, superhost)."""
    df = spark.createDataFrame(
        [(lid, m, m, hid, area, Decimal(p) if p is not None else None, a, "t" if act else "f",
          Decimal("50.00"), "t" if sup else "f") for lid, m, hid, area, p, a, act, sup in rows],
        "listing_id long, month_start date, scraped_date date, host_id long, "
        "listing_neighbourhood string, price decimal(18,2), availability_30 int, "
        "has_availability string, review_scores_rating decimal(5,2), host_is_superhost string")
    return (df.withColumn("is_active", F.when(F.col("has_availability") == "t", 1).otherwise(0))
            .withColumn("stays_in_30_days", F.greatest(F.lit(0), 30 - F.coalesce("availability_30", F.lit(0)))))


def test_mart_gaps_zero_previous_and_no_active(spark):
    jan, feb, apr, may = D(2020, 1, 1), D(2020, 2, 1), D(2020, 4, 1), D(2020, 5, 1)
    rows = [
        (1, jan, 10, "A", "100.00", 10, 0, 0),   # January: no active listing
        (1, feb, 10, "A", "100.00", 10, 1, 1),   # February: previous active count 0
        (2, feb, 11, "A", "101.00", 40, 1, 0),
        (1, apr, 10, "A", "100.00", 10, 1, 1),   # March missing: lag is February
        (1, may, 10, "A", None, 10, 1, 0),       # an active listing without price
        (5, jan, 12, None, "7.00", 0, 1, 0),     # no area: 'Unknown'
    ]
    out = {(r.listing_neighbourhood, r.month_start): r
           for r in marts.listing_neighbourhood_kpis(month_rows(spark, rows)).collect()}
    j = out[("A", jan)]
    assert (j.active_listings_rate, j.min_active_price, j.median_active_price, j.avg_active_price,
            j.total_active_stays, j.avg_estimated_rev_per_active_listing) == (0.0, None, None, None, 0, None)
    f = out[("A", feb)]
    assert f.pct_change_active_listings is None                     # previous count 0
    assert f.median_active_price == 100.5 and f.avg_active_price == 100.5
    assert f.total_active_stays == 20 and f.superhost_rate == 50.0
    assert f.avg_estimated_rev_per_active_listing == 1000.0         # (20*100 + 0*101) / 2
    a = out[("A", apr)]
    assert a.pct_change_active_listings == -50.0                    # 1 vs February's 2
    m = out[("A", may)]
    # sum(stays * price) over only NULL prices is NULL, as in SQL
    assert m.avg_active_price is None and m.avg_estimated_rev_per_active_listing is None
    assert ("Unknown", jan) in out


def test_census_share_with_zero_total(spark):
    cols = schemas.CENSUS_G01.names
    vals = {c: 0 for c in cols[1:]}
    row_zero = ["LGA1"] + [vals[c] for c in cols[1:]]
    row_some = ["LGA2"] + [10 if c == "tot_p_p" else (5 if c == "age_0_4_yr_p" else 0) for c in cols[1:]]
    g01 = spark.createDataFrame([row_zero, row_some], schemas.CENSUS_G01)
    g02 = spark.createDataFrame([("1", 30, None, None, None, None, None, None, Decimal("2.500")),
                                 ("LGA2", 31, 0, 0, 0, 0, None, 0, Decimal("1.000"))], schemas.CENSUS_G02)
    got = {r.lga_code_key: r.pct_age_0_4 for r in analysis.census_demographics(
        silver.silver_census_g01(g01), silver.silver_census_g02(g02)).collect()}
    assert got == {"1": None, "2": 0.5}


def test_top_bottom_with_ties_and_few_groups(spark):
    perf = spark.createDataFrame([("3", "c", 1, 5.0), ("1", "a", 1, 5.0), ("2", "b", 1, 9.0),
                                  ("4", "d", 1, None)],
                                 "lga_code_key string, lga_name string, active_listings long, "
                                 "avg_rev_per_active_listing double")
    top = [r.lga_code_key for r in analysis.top_lgas(perf).collect()]
    bottom = [r.lga_code_key for r in analysis.bottom_lgas(perf).collect()]
    assert top == ["2", "1", "3"]        # tie at the cut broken by the key, NULL last
    assert bottom == ["1", "3", "2"]
    tagged = analysis.tagged_top_bottom(perf)
    assert tagged.count() == 6           # fewer than 6 groups: the two lists overlap


def test_properties_on_driver_tables(spark):
    L = Layers(spark, "/root/testdata/sf0.001")
    month = marts.monthly_fact(L.fact, L.property_history, L.host_history)
    assert month.groupBy("listing_id", "month_start").count().where("count > 1").count() == 0
    demo = analysis.census_demographics(L.census_g01, L.census_g02)
    shares = [c for c in demo.columns if c.startswith("pct_age")]
    for r in demo.collect():
        assert all(0.0 <= r[c] <= 1.0 for c in shares)
        assert abs(sum(r[c] for c in shares) - 1.0) < 1e-9
    for r in analysis.mortgage_coverage(L.listings, L.lga_suburb, L.lga_code, L.census_g02).collect():
        assert 0 <= r.hosts_covering_mortgage <= r.total_single_listing_hosts
        assert 0.0 <= r.coverage_percentage <= 100.0


def test_host_mart_busiest_scrape_and_fan_out(spark):
    from lodgelake.plans import star
    d1, d2, d3 = D(2020, 3, 2), D(2020, 3, 20), D(2020, 3, 25)
    fact = spark.createDataFrame([
        (1, 10, d1, Decimal("100.00"), 5, "t"),    # 25 nights: the busiest scrape of listing 1
        (1, 10, d2, Decimal("999.00"), 20, "t"),   # later but less booked
        (2, 20, d2, Decimal("10.00"), 10, "t"),    # listing 2: tie on nights ...
        (2, 20, d3, Decimal("20.00"), 10, "t"),    # ... the later scrape wins
    ], "listing_id long, host_id long, scraped_date date, price decimal(18,2), "
       "availability_30 int, has_availability string")
    fact = fact.withColumn("review_scores_rating", F.lit(0).cast("decimal(5,2)"))
    hosts = spark.createDataFrame([(10, "O'Connor", d1), (20, "Elsewhere", d1)],
                                  "host_id long, host_neighbourhood string, scraped_date date")
    for c in ("host_name", "host_since", "host_is_superhost"):
        hosts = hosts.withColumn(c, F.lit(None).cast("date" if c == "host_since" else "string"))
    hist = star.host_history(hosts)
    suburbs = spark.createDataFrame([("o'connor", "South"), ("O'CONNOR", "North")],
                                    "suburb_name string, lga_name string")
    got = sorted((r.host_neighbourhood_lga, r.distinct_hosts_count, r.estimated_revenue_per_host)
                 for r in marts.mart_host_neighbourhood(fact, hist, suburbs).collect())
    # host 10: suburb in two LGAs -> the smallest name; revenue 25 x 100
    # host 20: no LGA -> its raw area; revenue 20 x 20 from the later tied scrape
    assert got == [("Elsewhere", 1, 400.0), ("North", 1, 2500.0)]
