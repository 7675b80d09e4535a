"""The daily run: stage, load, refresh, alert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadbook.operators import alerts, conform, quality
from roadbook.plans import staging, warehouse
from roadbook.sources import tables
from roadbook.sources.reference import default_thresholds

# staged domain: fact table, raw time column
LOADS = {
    "vehicles": ("fact_vehicle_telemetry", "timestamp"),
    "driver_health": ("fact_driver_shifts", "timestamp"),
    "finance": ("fact_daily_finance", "date"),
}


def run_day(
    spark: SparkSession, lake: str, staged: str, root: str, drivers: DataFrame, vehicles: DataFrame,
    alert_time: dt.datetime, mode: str = "strict", policy: str = "touched_keys",
) -> DataFrame:
    """Bring everything up to date and return the alerts of the newest day.

    Files are staged and loaded once, unless they change; what an earlier run has left undone is
    taken up. Rows that are stored as they are touch no day, so an unchanged rerun rewrites nothing.

    ``drivers`` and ``vehicles`` are the master lists (id, status). Errors propagate: a bad
    record in strict mode or a failed write stops the run.
    """
    for domain in LOADS:
        staging.stage(spark, domain, lake, staged, mode)
    for domain, (fact, ts_col) in LOADS.items():
        done = set(warehouse.loaded_files(spark, root, domain))
        files = [f for f in staging.staged_files(spark, staged, domain) if f not in done]
        if files:
            rows = conform.to_fact(staging.read_good(spark, staged, domain, [f[0] for f in files]), ts_col)
            warehouse.load_fact(spark, root, fact, rows)
            warehouse.note_loaded(spark, root, domain, files)
    warehouse.seed_thresholds(spark, root, default_thresholds(spark))
    warehouse.build_dimensions(spark, root, drivers, vehicles)
    warehouse.refresh_marts(spark, root, policy)
    return run_alerts(spark, root, alert_time)


def run_alerts(spark: SparkSession, root: str, alert_time: dt.datetime) -> DataFrame:
    """Evaluate the scheduled alerts on the stored marts and return the rows stored for this time."""
    marts = ["fact_driver_daily_metrics", "fact_vehicle_daily_metrics"]
    found = alerts.all_alerts(
        *[tables.read_table(spark, root, mart) for mart in marts],
        tables.read_current(spark, root, "dim_driver"),
        tables.read_current(spark, root, "alert_thresholds"),
        alert_time,
        *[tables.newest_day(spark, root, mart) for mart in marts],
    )
    tables.write_alerts(found, tables.table_path(root, "alerts"), alert_time)
    stored = tables.read_table(spark, root, "alerts")
    return stored.where(F.col("alert_time") == F.lit(alert_time).cast("timestamp_ntz"))


def run_checks(spark: SparkSession, root: str, as_of: dt.date) -> dict[str, DataFrame]:
    """The scheduled quality queries on the stored marts."""
    driver_mart = tables.read_table(spark, root, "fact_driver_daily_metrics")
    return {
        "nulls": quality.dq_nulls(driver_mart, ["driver_id", "date_key"]),
        "ranges": quality.dq_ranges(driver_mart),
        "freshness": quality.dq_freshness(driver_mart, as_of),
    }
