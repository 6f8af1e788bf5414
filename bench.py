"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from callmill.session import build_session
from checks import fixtures
from checks.queries import QUERIES

HEADLINES = [
    "m1_cost_per_lead",
    "m2_daily_leads_by_channel",
    "m3_channel_leaderboard",
    "m4_bookings_by_day",
    "m5_bookings_by_hour",
    "m6_meetings_by_day",
    "m7_meetings_by_hour",
    "m8_meetings_per_employee_per_day",
    "a3_outcomes",
    "b5_staging",
    "d6_dedup",
    "a17_daily_run",
    "m9_refresh",
]
REPEATS = 3


def seconds(query, spark, sf_dir: str) -> float:
    """Wall time to build the query and compute every row of it."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "callmill-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixtures.prepare(spark, sf_dir)
    seconds(QUERIES[HEADLINES[0]], spark, sf_dir)  # warm up the JVM
    times = {}
    for name in HEADLINES:
        runs = [seconds(QUERIES[name], spark, sf_dir) for _ in range(REPEATS)]
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()
