"""Driver risk page. ``driver=None`` reports on every driver in one pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from roadbook.functions.expressions import date_range, trailing


def _scope(driver_mart: DataFrame, driver: str | None, start: dt.date, end: dt.date) -> DataFrame:
    rows = date_range(driver_mart, start, end)
    return rows if driver is None else rows.where(F.col("driver_id") == driver)


def driver_summary(driver_mart: DataFrame, start: dt.date, end: dt.date, driver: str | None = None) -> DataFrame:
    return _scope(driver_mart, driver, start, end).groupBy("driver_id").agg(
        F.count_distinct("date_key").alias("active_days"),
        F.avg("avg_fatigue_index").alias("avg_fatigue"),
        F.sum("speeding_events").alias("total_speeding"),
        F.max("max_continuous_hours").alias("max_hours"),
        F.sum("fraud_alerts_count").alias("fraud_alerts"),
    )


def driver_summary_flags(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        {
            "fatigue_label": F.when(F.col("avg_fatigue") > 0.65, "Risk").otherwise("Safe"),
            "hours_label": F.when(F.col("max_hours") > 8, "Violation").otherwise("Compliant"),
        }
    )


def driver_trend(driver_mart: DataFrame, start: dt.date, end: dt.date, driver: str | None = None) -> DataFrame:
    return (
        _scope(driver_mart, driver, start, end)
        .select("driver_id", F.col("date_key").alias("date"), "avg_fatigue_index", "max_continuous_hours")
        .orderBy("driver_id", "date")
    )


def speeding_profile(driver_mart: DataFrame, start: dt.date, end: dt.date, driver: str | None = None) -> DataFrame:
    return (
        _scope(driver_mart, driver, start, end)
        .select("driver_id", F.col("date_key").alias("date"), "speeding_events")
        .orderBy("driver_id", "date")
    )


def audit_log(driver_mart: DataFrame, start: dt.date, end: dt.date, driver: str | None = None) -> DataFrame:
    """Days with a policy violation, newest first."""
    violation = (
        (F.col("avg_fatigue_index") > 0.7)
        | (F.col("max_continuous_hours") > 8)
        | (F.col("speeding_events") > 10)
        | (F.col("fraud_alerts_count") > 0)
    )
    return (
        _scope(driver_mart, driver, start, end).where(violation)
        .select(
            "driver_id",
            "date_key",
            F.round("avg_fatigue_index", 2).alias("fatigue"),
            F.col("max_continuous_hours").alias("shift_hrs"),
            F.col("speeding_events").alias("speeding"),
            F.col("fraud_alerts_count").alias("fraud"),
        )
        .orderBy(F.desc("date_key"), "driver_id")
    )


def status_hours(dim_driver: DataFrame, shifts: DataFrame) -> DataFrame:
    """Joined rows, drivers and hours per status.

    ``driver_count`` counts rows of the driver-to-shift join (one per shift, one for a driver
    without shifts); ``distinct_drivers`` counts drivers. Shifts are summed per driver before
    the join, which gives the same numbers without fanning out a busy driver.
    """
    per_driver = shifts.groupBy("driver_id").agg(
        F.count("*").alias("shift_rows"), F.sum("shift_hours").alias("hours")
    )
    joined = dim_driver.select("driver_id", "status").join(per_driver, "driver_id", "left")
    return joined.groupBy("status").agg(
        F.sum(F.coalesce("shift_rows", F.lit(1))).alias("driver_count"),
        F.count("driver_id").alias("distinct_drivers"),
        F.coalesce(F.sum("hours"), F.lit(0.0)).alias("total_fleet_hours"),
    )


def fatigue_streaks(driver_mart: DataFrame, limit: float = 0.7, min_days: int = 4) -> DataFrame:
    """Runs of consecutive days over a fatigue limit.

    The window is per driver over mart rows, so a partition holds at most one row per day.
    """
    by_day = Window.partitionBy("driver_id").orderBy("date_key")
    tired = driver_mart.where(F.col("avg_fatigue_index") > limit).select(
        "driver_id", "date_key", F.row_number().over(by_day).alias("nth")
    )
    # consecutive days minus their rank give the same anchor date
    runs = tired.groupBy("driver_id", F.date_sub("date_key", F.col("nth")).alias("anchor")).agg(
        F.min("date_key").alias("first_day"),
        F.max("date_key").alias("last_day"),
        F.count("*").alias("days"),
    )
    return runs.where(F.col("days") >= min_days).drop("anchor").orderBy(F.desc("days"), "driver_id", "first_day")


def top_earners(driver_mart: DataFrame, days: int = 7, k: int = 5) -> DataFrame:
    return (
        trailing(driver_mart, days)
        .groupBy("driver_id").agg(F.sum("net_profit").alias("profit"))
        .orderBy(F.desc("profit"), "driver_id")
        .limit(k)
    )
