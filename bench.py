"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tessela.plans.catalogue import QUERIES

HEADLINE = ("metrics_geral", "metrics_long", "iqr_by_parking", "summary_stats", "boxplot_stats", "window_3m", "fixed_centres_assign", "study_apt", "study_house", "rank_vgv", "rank_sections", "manager_detail", "registry_compare", "exits_new", "capture_append", "dedupe_first")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            began = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total seconds of the headline queries, median of 3 warm runs each", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
