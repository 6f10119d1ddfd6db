"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads, BENCH_RUNS the warm runs
per query (the median counts).  Each run builds the plan anew and writes the full result
to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from vintage_panel import get_spark
from vintage_panel.plans.catalog import spark_queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "population",
    "first_event_date",
    "mob_pivot",
    "dpd_panel",
    "model_target",
    "waterfall_total",
    "balance_panel",
    "credit_line_panel",
    "net_sales",
    "panel_join",
    "behaviour_aggregate",
    "segment_rates",
    "correlation_pairs",
    "target_summary",
    "woe_table",
    "clean_features",
)


def main() -> None:
    spark = get_spark(
        f"local[{CPUS}]",
        "vintage_panel_bench",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = spark_queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):  # the first run warms up
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
