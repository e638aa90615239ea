"""Times the queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed
runs per query after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from centerline.plans.catalogue import QUERIES  # noqa: E402
from centerline.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds of all queries, warm", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))


if __name__ == "__main__":
    main()
