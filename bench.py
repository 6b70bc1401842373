"""Times the headline queries on one data set and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from testbed.queries import QUERIES

HEADLINES = [
    "stg_awards_latest", "niche_labels_free_text", "recompete_list", "obligations_by_action", "agency_dimension",
    "vendor_share_rank", "award_events", "dash_market", "obligations_by_fy_yoy", "wins_by_vendor_fy",
    "gate_duplicates", "exact_dedupe", "audit_results", "flatten_transactions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    seconds = {}
    for name in HEADLINES:
        # The first run compiles the generated code and warms the JVM; the second one is reported.
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
