"""Wall-clock of the headline queries, the median of three runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

from diamondlake.plans.queries import QUERIES

# One per job and per kind of plan. One query warms the JVM up; everything a query does, the
# count of rows per game included, belongs to its own time.
HEADLINE = [
    "pitch_table", "pa_seq", "pitch_counts", "recent_speed_avg", "pa_aggregate", "runs_scored", "pa_wpa",
    "wpa_by_result", "wpa_by_result_full", "wpa_spearman", "wpa_verdict", "convention_hypotheses",
    "numeric_profile", "situation_dist", "training_set", "csv_roundtrip",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["wpa_by_result"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    result = {
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(folder).name.removeprefix("sf") or 0),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
