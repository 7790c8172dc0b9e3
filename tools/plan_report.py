"""Write the final (adaptive) physical plan of each headline query to
docs/plans/<name>.txt and print a table of the operators that matter at scale.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

from lodgelake.operators import scd2  # noqa: E402
from lodgelake.plans import analysis, marts  # noqa: E402
from lodgelake.plans.layers import Layers, MaterialisedLayers  # noqa: E402
from lodgelake.session import build_session, scratch_path  # noqa: E402

OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate",
       "ObjectHashAggregate", "Expand", "Window", "WindowGroupLimit", "Sort", "Generate"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    L = MaterialisedLayers.build(Layers(spark, sf), scratch_path(spark, "plans"))
    plans = {
        "mart_listing_neighbourhood": marts.listing_neighbourhood_kpis(L.fact_month),
        "mart_property_type": marts.property_type_kpis(L.fact_month),
        "monthly_fact": marts.monthly_fact(L.fact, L.property_history, L.host_history),
        "mart_host_neighbourhood": marts.mart_host_neighbourhood(L.fact, L.host_history, L.lga_suburb),
        "scd2_host_history": scd2.build_history(
            L.listings.select("host_id", "host_name", "host_since", "host_is_superhost",
                              "host_neighbourhood", "scraped_date").distinct()
            .withColumn("updated_at", L.listings.scraped_date.cast("timestamp_ntz")),
            "host_id", ["host_name", "host_since", "host_is_superhost", "host_neighbourhood"]),
        "top_bottom_demographics": analysis.top_bottom_demographics(
            L.listings, L.lga_suburb, L.lga_code, L.census_g01, L.census_g02),
        "age_vs_revenue": analysis.age_vs_revenue(L.listings, L.lga_suburb, L.lga_code, L.census_g02),
        "best_listing_type": analysis.best_listing_type(L.listings),
        "host_concentration": analysis.host_concentration(L.listings, L.lga_suburb, L.lga_code),
        "mortgage_coverage": analysis.mortgage_coverage(L.listings, L.lga_suburb, L.lga_code,
                                                        L.census_g02),
    }
    print("| query | " + " | ".join(OPS) + " |")
    print("|---" * (len(OPS) + 1) + "|")
    for name, df in plans.items():
        df.write.format("noop").mode("overwrite").save()
        df.collect() if name != "monthly_fact" else df.count()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        with open(f"docs/plans/{name}.txt", "w") as fh:
            fh.write(text)
        tree = text.split("\n\n", 1)[0]
        if "== Final Plan ==" in tree:
            tree = tree.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        counts = [len(re.findall(rf"[ *]{op}\b[^\n(]*\(\d+\)", tree)) for op in OPS]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main()
