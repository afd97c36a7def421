"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3) and
BENCH_QUERIES (comma-separated names) choose what is run. Each query is run once to warm up;
its time is the median of the following runs, with all result rows computed and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from saleslayers.catalog.registry import QUERIES
from saleslayers.session import build_session

HEADLINE = (
    "bronze_sale_orders",
    "fact_quality_counts",
    "dedupe_fact",
    "merge_upsert",
    "scd2_customers",
    "star_join",
    "gold_sales_summary",
    "gold_by_country",
    "gold_supplier_daily",
    "gold_supplier_monthly",
    "gold_merge_refresh",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "20g",
            "spark.sql.shuffle.partitions": str(cpus),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
