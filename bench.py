"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores,
BENCH_RUNS the timed runs per query after one warm run (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from personpub.plans.catalog import CASES
from personpub.session import build_session

HEADLINE = (
    "statistics",
    "full_rebuild",
    "publish_increment",
    "publish_update",
    "properties_est",
    "sync_state",
    "latest",
    "apply_changes",
    "records_json",
    "export_round_trip",
    "running_totals",
    "build_index",
    "store_words",
    "bm25_stored",
    "should",
    "multi_match",
    "nested",
    "entity_search",
    "entity_find",
    "deep_page",
    "real_changes",
    "statistics_from_changes",
    "relatives_republished",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "personpub-bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            df = CASES[name].query(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
