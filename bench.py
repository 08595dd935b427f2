"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of threads,
BENCH_RUNS how often each query is timed after two warm-up runs. The median counts.
Results go to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tierstone.registry.queries import QUERIES
from tierstone.session import build_session

HEADLINE = (
    "item_performance",
    "item_performance_bulk",
    "top_selling_items",
    "top_selling_items_bulk",
    "sales_performance_24h",
    "pageviews_by_channel",
    "user_engagement_segments",
    "purchases_enriched",
    "purchases_enriched_bulk",
    "pageviews_by_items",
    "revenue_by_category",
    "rfm_full",
    "latest_per_key",
    "quality_gates",
    "full_refresh",
    "json_ingest",
    "incremental_load",
    "stored_upsert",
    "compaction",
    "stream_pageviews",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "tierstone-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=8 if cpus == "*" else int(cpus),
        extra={"spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in HEADLINE:
        for _ in range(2):
            seconds(spark, name, sf_dir)
        timed[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(timed.values()), 4),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
