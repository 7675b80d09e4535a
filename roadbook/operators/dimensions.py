"""Calendar, driver and vehicle dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadbook.functions.expressions import vehicle_type
from roadbook.operators import upserts
from roadbook.sources.reference import date_spine


def date_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_key``; weeks are ISO weeks."""
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        F.weekofyear("date_key").alias("week_of_year"),
        F.date_format("date_key", "EEEE").alias("day_of_week"),
        F.dayofweek("date_key").isin(1, 7).alias("is_weekend"),
    )


def build_dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return date_attributes(date_spine(spark, start, end))


def latest_activity(events: DataFrame, key: str = "driver_id") -> DataFrame:
    """First and last event time per member."""
    return events.groupBy(key).agg(
        F.min("event_timestamp").alias("seen_first"), F.max("event_timestamp").alias("seen_last")
    )


def driver_master(master: DataFrame, activity: DataFrame) -> DataFrame:
    return master.select("driver_id", "status").join(activity, "driver_id", "left")


def build_dim_driver(dim: DataFrame, master: DataFrame, shifts: DataFrame) -> DataFrame:
    """Next state of the driver dimension."""
    source = driver_master(master, latest_activity(shifts))
    return upserts.null_epoch(upserts.merge_driver(dim, source))


def build_dim_vehicle(dim: DataFrame, master: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Next state of the vehicle dimension; timestamps always mirror the telemetry fact."""
    merged = upserts.merge_vehicle(dim, master, vehicle_type("vehicle_id"))
    seen = latest_activity(telemetry, "vehicle_id")
    # members without telemetry get nulls from the left join
    dated = merged.join(seen, "vehicle_id", "left").select(
        "vehicle_id",
        "vehicle_type",
        "status",
        F.col("seen_first").alias("first_seen_at"),
        F.col("seen_last").alias("last_seen_at"),
    )
    return upserts.null_epoch(dated, null_when_missing=False)
