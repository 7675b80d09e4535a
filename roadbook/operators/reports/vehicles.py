"""Vehicle monitor page. ``vehicle=None`` reports on every vehicle in one pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from roadbook.functions.expressions import date_range, threshold

# Fallback limits of the vehicle page where the threshold table has no row.
TEMP_WARN, TEMP_CRIT, BATTERY_WARN = 95.0, 105.0, 11.8


def _scope(vehicle_mart: DataFrame, vehicle: str | None, start: dt.date, end: dt.date) -> DataFrame:
    rows = date_range(vehicle_mart, start, end)
    return rows if vehicle is None else rows.where(F.col("vehicle_id") == vehicle)


def vehicle_summary(
    dim_vehicle: DataFrame, vehicle_mart: DataFrame, start: dt.date, end: dt.date,
    vehicle: str | None = None,
) -> DataFrame:
    """Figures per vehicle of the dimension; zeros and ``is_ghost`` without any day."""
    figures = _scope(vehicle_mart, vehicle, start, end).groupBy("vehicle_id").agg(
        F.count_distinct("date_key").alias("active_days"),
        F.avg("avg_speed_kph").alias("avg_speed"),
        F.max("max_speed_kph").alias("max_speed"),
        F.avg("avg_engine_temp_c").alias("avg_engine_temp"),
        F.avg("avg_battery_voltage").alias("avg_battery"),
        F.sum("speeding_events").alias("total_speeding"),
    )
    fleet = dim_vehicle.select("vehicle_id")
    if vehicle is not None:
        fleet = fleet.where(F.col("vehicle_id") == vehicle)
    zeroed = {
        c: F.when(F.col("active_days").isNull(), F.lit(0)).otherwise(F.col(c))
        for c in figures.columns if c not in ("vehicle_id", "active_days")
    }
    return (
        fleet.join(figures, "vehicle_id", "left")
        .withColumns(zeroed)
        .withColumn("is_ghost", F.col("active_days").isNull())
        .withColumn("active_days", F.coalesce("active_days", F.lit(0)))
    )


def vehicle_status(summary: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Engine and battery state of a vehicle summary."""
    temp, volts = F.col("avg_engine_temp"), F.col("avg_battery")
    warn = threshold(thresholds, "engine_temp_c", default=TEMP_WARN)
    crit = threshold(thresholds, "engine_temp_c", "critical", default=TEMP_CRIT)
    low = threshold(thresholds, "battery_voltage", default=BATTERY_WARN)
    return summary.withColumns(
        {
            "engine_level": F.when(temp >= crit, "critical").when(temp >= warn, "warning").otherwise("normal"),
            "engine_label": F.when(temp > warn, "OVERHEAT").otherwise("Optimal"),
            "battery_label": F.when(volts < low, "LOW").otherwise("Healthy"),
        }
    )


def maintenance(summary: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row per recommendation.

    Vehicles without telemetry have zero volts in the summary and are therefore listed as
    electrical warnings, as on the page.
    """
    temp, volts = F.col("avg_engine_temp"), F.col("avg_battery")
    warn = threshold(thresholds, "engine_temp_c", default=TEMP_WARN)
    crit = threshold(thresholds, "engine_temp_c", "critical", default=TEMP_CRIT)
    low = threshold(thresholds, "battery_voltage", default=BATTERY_WARN)
    engine = F.when(temp >= crit, "CRITICAL OVERHEAT").when(temp >= warn, "Temperature Warning")
    electric = F.when(volts < low, "Electrical Warning")
    judged = summary.select(
        "vehicle_id", "avg_engine_temp", "avg_battery",
        F.array_compact(F.array(engine, electric)).alias("findings"),
    )
    return judged.select(
        "vehicle_id", "avg_engine_temp", "avg_battery", F.explode("findings").alias("recommendation")
    )


def engine_trend(vehicle_mart: DataFrame, start: dt.date, end: dt.date, vehicle: str | None = None) -> DataFrame:
    return (
        _scope(vehicle_mart, vehicle, start, end)
        .select("vehicle_id", "date_key", "avg_engine_temp_c")
        .orderBy("vehicle_id", "date_key")
    )


def stress_series(vehicle_mart: DataFrame, start: dt.date, end: dt.date, vehicle: str | None = None) -> DataFrame:
    return (
        _scope(vehicle_mart, vehicle, start, end)
        .select("vehicle_id", "date_key", "speeding_rate", "avg_speed_kph")
        .orderBy("vehicle_id", "date_key")
    )


def operational_log(vehicle_mart: DataFrame, start: dt.date, end: dt.date, vehicle: str | None = None) -> DataFrame:
    """Daily figures, newest first."""
    return (
        _scope(vehicle_mart, vehicle, start, end)
        .select(
            "vehicle_id", "date_key", "avg_speed_kph", "max_speed_kph", "avg_engine_temp_c",
            "avg_battery_voltage", "speeding_events",
        )
        .orderBy(F.desc("date_key"), "vehicle_id")
    )
