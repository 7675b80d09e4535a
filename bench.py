"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) select data and cores.
Every query runs twice; the second run is reported, the first one under ``cold``.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import queries
from roadbook.session import spark_session

HEADLINE = [
    "driver_daily_metrics", "vehicle_daily_metrics", "changed_driver_days", "refresh_driver_touched_keys",
    "refresh_vehicle_touched_keys", "dedup", "upsert", "insert_ignore", "dim_driver", "dim_vehicle",
    "stage_vehicles", "stage_finance_daily", "stage_trips", "rollup_trips", "reconcile_finance",
    "alert_fatigue", "alert_thresholds_generic", "alert_digest", "harsh_brake", "replay_buffer",
    "dq_ranges", "investigation_leads", "executive_kpis", "driver_summary", "vehicle_summary",
    "finance_kpis", "risk_reward", "status_hours", "fatigue_streaks", "histogram",
    "all_alerts", "load_fact_replace", "stream_refresh", "stream_harsh_brake",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = spark_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # no Python stack capture per column expression
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry, cold, warm = queries(), {}, {}
    for times in (cold, warm):
        for key in HEADLINE:
            begin = time.perf_counter()
            registry[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time of the second run",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
