"""Headline queries: one warm-up, then the median of BENCH_RUNS runs, to the noop sink.

A run is the whole query: building the plan, settling its lookups and executing it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from benthoframe.plans.queries import QUERIES
from benthoframe.session import recommended_builder

HEADLINE = (
    "density_by_station_taxon",
    "individuals",
    "cleaned_entries",
    "community_density_family",
    "station_area_volume",
    "water_depth",
    "track_length_gps",
    "name_resolution_all",
    "conv_prepared_regressions",
    "violations_row_rules",
    "violations_duplicate_ids",
    "violations_sample_weights",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        recommended_builder("benthoframe-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
