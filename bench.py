"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collection), once to warm up and then three times; the median is
reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorlake.plans.catalog import CATALOG  # noqa: E402
from sensorlake.session import get_session  # noqa: E402

HEADLINE = [
    "gold_pm25", "gold_temperature", "gold_activity", "silver_readings", "rejected_readings",
    "enriched_readings", "bronze_decode", "pressure_alerts", "unregistered_sensors",
    "new_unregistered_alerts", "quality_report", "sensor_profiles", "upsert_dims",
]
# What runs every hour: two landings with a refresh of silver and a mart each
# (full, then incremental), and a stream over two waves with a restart.
HOURLY = ["incremental_gold_activity", "stream_hourly"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE + HOURLY
    spark = get_session(f"local[{cpus}]", app="sensorlake-bench", shuffle_partitions=int(cpus) * 2,
                        **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    results = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up: JIT, file listing, broadcast size checks
        results[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(1 if name in HOURLY else repeats)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "repeats": repeats}))


if __name__ == "__main__":
    main()
