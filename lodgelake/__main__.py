"""Command line: load CSV drops, build the warehouse, write marts and analyses.

  python -m lodgelake load    --landing DIR --warehouse DIR [--monthly]
  python -m lodgelake build   --warehouse DIR [--sf-dir DIR] [--full]
  python -m lodgelake report  --warehouse DIR --out DIR [--format parquet|csv]

``load`` appends listing month drops to ``<warehouse>/bronze/airbnb_raw`` with
insert-ignore semantics (all pending months, or with ``--monthly`` only the
earliest unloaded one) and refreshes the census and mapping tables when their
files are present; ``build`` writes silver, history, star and the monthly
fact, after the first time only for the months with new rows unless ``--full`` (from the loaded bronze tables, or from the driver tables with
``--sf-dir``); ``report`` writes the three marts and the six analyses.
"""

from __future__ import annotations

import argparse

from lodgelake import schemas
from lodgelake.plans import analysis
from lodgelake.plans.layers import Layers, MaterialisedLayers
from lodgelake.session import cluster_session, scratch_path
from lodgelake.sources import files, ingest

CENSUS_KINDS = ["census_g01", "census_g02", "nsw_lga_suburb", "nsw_lga_code"]


def _bronze_dir(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/bronze"


def load(spark, landing: str, warehouse: str, monthly: bool) -> None:
    bronze = _bronze_dir(warehouse)
    ledger = f"{bronze}/_ledger"
    names = files.list_files(spark, landing)
    for kind in CENSUS_KINDS:
        picked = files.select_files(names, kind)
        if picked:
            df = ingest.read_census(spark, [f"{landing.rstrip('/')}/{n}" for n in picked], kind)
            ingest.full_refresh(f"{bronze}/{kind}", df)
    if monthly:
        ingest.load_next_month(spark, landing, f"{bronze}/airbnb_raw", ledger,
                               scratch_path(spark, "staged"))
        return
    ingest.load_pending(spark, landing, f"{bronze}/airbnb_raw", ledger, scratch_path(spark, "staged"))


def bronze_tables(spark, warehouse: str):
    bronze = _bronze_dir(warehouse)
    out = {"airbnb_raw": ingest.read_bronze(spark, f"{bronze}/airbnb_raw")}
    for kind in CENSUS_KINDS:
        out[kind] = ingest.table_or_none(spark, f"{bronze}/{kind}", schemas.BRONZE[kind])
        if out[kind] is None:
            out[kind] = spark.createDataFrame([], schemas.BRONZE[kind])
    return out


def build(spark, warehouse: str, sf_dir: str | None, full: bool = False) -> MaterialisedLayers:
    tables = f"{warehouse.rstrip('/')}/tables"
    if sf_dir:
        return MaterialisedLayers.build(Layers(spark, sf_dir), tables)
    layers = Layers(spark, bronze=bronze_tables(spark, warehouse))
    if full:
        return MaterialisedLayers.build(layers, tables)
    return MaterialisedLayers.update(layers, tables, f"{_bronze_dir(warehouse)}/airbnb_raw")


def report(spark, warehouse: str, out: str, fmt: str) -> None:
    L = MaterialisedLayers(spark, f"{warehouse.rstrip('/')}/tables")
    results = {
        "dm_listing_neighbourhood": L.mart_listing_neighbourhood(),
        "dm_property_type": L.mart_property_type(),
        "dm_host_neighbourhood": L.mart_host_neighbourhood(),
        "top_bottom_demographics": analysis.top_bottom_demographics(
            L.listings, L.lga_suburb, L.lga_code, L.census_g01, L.census_g02),
        "age_vs_revenue": analysis.age_vs_revenue(L.listings, L.lga_suburb, L.lga_code, L.census_g02),
        "age_revenue_corr": analysis.age_revenue_corr(L.listings, L.lga_suburb, L.lga_code,
                                                      L.census_g02),
        "best_listing_type": analysis.best_listing_type(L.listings),
        "host_concentration": analysis.host_concentration(L.listings, L.lga_suburb, L.lga_code),
        "mortgage_coverage": analysis.mortgage_coverage(L.listings, L.lga_suburb, L.lga_code,
                                                        L.census_g02),
    }
    for name, df in results.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{out.rstrip('/')}/{name}")
        else:
            w.parquet(f"{out.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="lodgelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--monthly", action="store_true")
    p = sub.add_parser("build")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--sf-dir")
    p.add_argument("--full", action="store_true")
    p = sub.add_parser("report")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = ap.parse_args(argv)
    spark = cluster_session()  # master and sizes as submitted
    if args.cmd == "load":
        load(spark, args.landing, args.warehouse, args.monthly)
    elif args.cmd == "build":
        build(spark, args.warehouse, args.sf_dir, args.full)
    else:
        report(spark, args.warehouse, args.out, args.format)


if __name__ == "__main__":
    main()
