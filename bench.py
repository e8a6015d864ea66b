"""Benchmark: headline rule queries over the events table.

Runs each query once to warm up, then times ``repeat`` full executions
(result collected to force every stage) and reports the median.  Prints one
JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3), BENCH_QUERIES (comma list, default headline set)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rulestream.plans import catalog  # noqa: E402
from rulestream.session import local_session  # noqa: E402

HEADLINE = ["single_event", "single_event_100", "nested_condition", "threshold", "threshold_small", "threshold_fine", "unique_threshold",
            "anomaly_1h", "drop_to_zero", "sequence_alerts", "all_blocks_alerts", "matched_joined"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="rulestream-bench",
                          extra={"spark.ui.showConsoleProgress": "false"})
    qs = catalog.queries()
    times, rows = {}, {}
    for name in names:
        fn = qs[name]
        rows[name] = len(fn(spark, sf_dir).collect())  # warm-up
        ts = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).collect()
            ts.append(time.perf_counter() - t0)
            spark.catalog.clearCache()
        times[name] = round(statistics.median(ts), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "rule_query_median_sec_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows": rows, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
