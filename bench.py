"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regchron.plans.catalog import QUERIES  # noqa: E402
from regchron.session import build_session  # noqa: E402

HEADLINE = [
    "staging",
    "history_replay",
    "merge_last_run",
    "current_buildings",
    "changed_buildings",
    "point_in_time",
    "stock_summary",
    "status_transitions",
    "check_results",
    "check_report_by_name",
    "latest_order",
    "row_fingerprint",
    "registry_xml",
    "tsv_extract",
    "bulk_load_once",
    "bronze_append",
    "normalised_text",
    "percent_difference",
    "run_records",
    "watermark_safe",
    "history_merge",
    "refresh_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_order"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        times = []
        for attempt in range(runs + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
            if attempt == 0 and times[0] > 90:
                break
        # The first run warms up; a query that takes very long is taken as it is.
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
