"""Data-quality checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from roadbook.functions.expressions import latest, threshold


def dq_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which any of the columns is null."""
    bad = reduce(or_, [F.col(c).isNull() for c in cols])
    return df.agg(F.count_if(bad).alias("bad_rows"))


def orphans(fact: DataFrame, dim: DataFrame, key: str = "driver_id") -> DataFrame:
    """Fact members that the dimension does not list, with their row counts.

    Counted before the join, so a hot member costs one row.
    """
    counted = fact.groupBy(key).agg(F.count("*").alias("fact_rows"))
    return counted.join(dim.select(key), key, "left_anti")


# Limits beyond which a driver-day cannot be right.
RANGE_LIMITS = {
    "avg_speed_kph": 180,
    "total_shift_hours": 24,
    "max_continuous_hours": 12,
    "avg_fatigue_index": 1,
}
PROFIT_FLOOR = -1000


def dq_ranges(driver_mart: DataFrame, latest_only: bool = True) -> DataFrame:
    """Driver-days with impossible values, on the newest day or over all days."""
    rows = latest(driver_mart) if latest_only else driver_mart
    over = [F.col(c) > limit for c, limit in RANGE_LIMITS.items()]
    return rows.where(reduce(or_, over) | (F.col("net_profit") < PROFIT_FLOOR))


def dq_freshness(mart: DataFrame, as_of: dt.date) -> DataFrame:
    newest = mart.agg(F.max("date_key").alias("latest_data_point"))
    lag = F.datediff(F.lit(as_of), "latest_data_point")
    return newest.select(
        "latest_data_point",
        lag.alias("days_of_lag"),
        F.when(lag > 1, F.lit("OUTDATED")).otherwise(F.lit("FRESH")).alias("status"),
    )


def ghost_assets(dim: DataFrame) -> DataFrame:
    """Members never seen."""
    return dim.agg(F.count_if(F.col("last_seen_at").isNull()).alias("ghost_count"))


def investigation_leads(
    vehicle_mart: DataFrame, driver_mart: DataFrame, thresholds: DataFrame,
    temp_default: float = 95, fatigue_default: float = 0.65,
) -> DataFrame:
    """Hot vehicles and tired drivers of the newest day, values as text."""
    temp, tired = F.col("avg_engine_temp_c"), F.col("avg_fatigue_index")
    hot = latest(vehicle_mart).where(temp > threshold(thresholds, "engine_temp_c", default=temp_default))
    risky = latest(driver_mart).where(
        tired > threshold(thresholds, "avg_fatigue_index", default=fatigue_default)
    )

    def lead(df: DataFrame, category: str, entity: str, issue: str, value: Column) -> DataFrame:
        return df.select(
            F.lit(category).alias("category"),
            F.col(entity).alias("entity_id"),
            F.lit(issue).alias("issue_type"),
            value.alias("value"),
        )

    degrees = F.concat(F.round(temp, 1).cast("string"), F.lit("°C"))
    index = F.round(tired, 2).cast("string")
    return lead(hot, "Vehicle", "vehicle_id", "High Temp", degrees).unionByName(
        lead(risky, "Driver", "driver_id", "High Fatigue", index)
    )


def health_score(lag: str | Column, leads: str | Column) -> Column:
    """Healthy, Degraded or Critical from the data lag and the number of leads."""
    lag = F.col(lag) if isinstance(lag, str) else lag
    leads = F.col(leads) if isinstance(leads, str) else leads
    return (
        F.when((lag > 3) | (leads > 10), F.lit("Critical"))
        .when((lag > 1) | (leads > 0), F.lit("Degraded"))
        .otherwise(F.lit("Healthy"))
    )


def system_health(
    vehicle_mart: DataFrame, driver_mart: DataFrame, thresholds: DataFrame, as_of: dt.date,
) -> DataFrame:
    """Lag, leads, null keys and the resulting score, one row."""
    leads = investigation_leads(vehicle_mart, driver_mart, thresholds)
    state = vehicle_mart.agg(
        F.datediff(F.lit(as_of), F.max("date_key")).alias("days_lag"),
        F.count_if(F.col("vehicle_id").isNull()).alias("null_keys"),
        F.max("date_key").alias("last_data_date"),
    )
    return state.withColumn("leads", leads.select(F.count("*").alias("leads")).scalar()).withColumn(
        "health", health_score("days_lag", "leads")
    )


def ingestion_volume(mart: DataFrame, n: int = 14) -> DataFrame:
    """Rows per day of the last ``n`` days that have any, oldest first."""
    per_day = mart.groupBy("date_key").agg(F.count("*").alias("record_count"))
    return per_day.orderBy(F.desc("date_key")).limit(n).orderBy("date_key")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
