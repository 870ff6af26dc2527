"""Time the reports and print one JSON line.

BENCH_SF_DIR names the given tables (default /root/testdata/sf0.1) and
BENCH_CPUS the local cores (default 8). Each query runs in full into a sink
that throws the rows away, so planning, scan, shuffle and every projected
column count and nothing passes through the driver. After one round to warm
up, the best of BENCH_RUNS rounds (default 1) stands.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks import CHECKS  # noqa: E402

HEADLINE = [
    name for name in CHECKS if name.startswith("r") and not name.startswith("r15_")
] + ["r15_emergency_indicators", "j7_stay_as_of", "j8_event_in_interval", "j9_event_in_interval_left", "j13_fan_out_count"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardbook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    best: dict[str, float] = {}
    names = [n for n in dict.fromkeys(HEADLINE) if not only or any(n.startswith(o) for o in only)]
    for round_ in range(runs + 1):
        for name in names:
            began = time.perf_counter()
            CHECKS[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            if round_:
                best[name] = min(took, best.get(name, took))
    queries = {name: round(t, 3) for name, t in best.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
