"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the cores, BENCH_RUNS how often
each query runs (the median counts), BENCH_ONLY a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyforge import plans  # noqa: E402
from tallyforge.session import get_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = get_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only or plans.QUERIES:
        times = []
        # The first run loads classes and compiles, and does not count
        for _ in range(runs + 1):
            start = time.perf_counter()
            result = plans.QUERIES[name](spark, folder)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
