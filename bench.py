"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 1); the median counts. The result is forced by a `noop` write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from brickyard.plans import catalog
from brickyard.plans.registry import QUERIES
from brickyard.session import build_session

HEADLINE = [
    "stg_parcels_warehouse", "stg_sales_warehouse", "jn02_property_features", "jn03_market_context", "mart_valuations_warehouse",
    "mart_segments", "mart_segments_warehouse", "fe04_property_features", "fe12_target_encode", "ag07_kpi_row", "ag09_borough_summary",
    "ag18_box_stats", "ts08_momentum", "rk01_outcome_risk", "rk05_scenario_grid", "rk06_portfolio_risk", "ds01_distress_labels",
    "ds05_classifier_metrics", "gr04_key_players", "gr11_investment_flow", "hr03_ols_coefficients",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    catalog.load()
    spark = build_session("bench", cores=cpus, spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        spent = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(spent[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
