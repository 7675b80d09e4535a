"""Fleet overview and executive pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadbook.functions.expressions import latest, latest_day, rate, threshold, trailing

# Fallback limits of the executive page where the threshold table has no row.
TEMP_FALLBACK = 90.0
FATIGUE_FALLBACK = 0.7


def fleet_inventory(dim_vehicle: DataFrame) -> DataFrame:
    return dim_vehicle.agg(
        F.count("*").alias("total_vehicles"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_count"),
        F.count_if(F.col("last_seen_at").isNull()).alias("ghost_count"),
    )


def readiness(dim_vehicle: DataFrame) -> DataFrame:
    """Share of active vehicles in percent; zero for an empty fleet."""
    counts = fleet_inventory(dim_vehicle)
    share = F.coalesce(rate("active_count", "total_vehicles"), F.lit(0.0)) * 100
    return counts.select("total_vehicles", "active_count", share.alias("ready_pct"))


def latest_date(df: DataFrame) -> DataFrame:
    return df.agg(F.max("date_key").alias("latest_date"))


def overheating_count(vehicle_mart: DataFrame, limit: float | Column = 100) -> DataFrame:
    """Vehicles over a temperature limit on the newest day."""
    hot = latest(vehicle_mart).where(F.col("avg_engine_temp_c") > limit)
    return hot.agg(F.count_distinct("vehicle_id").alias("overheating"))


def profit_today(driver_mart: DataFrame) -> DataFrame:
    return latest(driver_mart).agg(F.sum("net_profit").alias("net_profit"))


def status_distribution(dim: DataFrame) -> DataFrame:
    return dim.groupBy("status").agg(F.count("*").alias("count"))


def driver_activity(dim_driver: DataFrame) -> DataFrame:
    """Every driver with the last active day, most recent first, never seen last."""
    day = F.when(F.col("last_seen_at").isNull(), F.lit("N/A")).otherwise(
        F.date_format("last_seen_at", "yyyy-MM-dd")
    )
    return dim_driver.orderBy(F.desc_nulls_last("last_seen_at"), "driver_id").select(
        "driver_id", F.col("status").alias("current_status"), day.alias("last_activity")
    )


def issue_feed(vehicle_mart: DataFrame) -> DataFrame:
    """Hot or speeding vehicles of the newest day."""
    temp = F.col("avg_engine_temp_c")
    severity = F.when(temp > 110, F.lit("CRITICAL")).otherwise(F.lit("WARNING"))
    return latest(vehicle_mart).where((temp > 100) | (F.col("speeding_events") > 15)).select(
        "vehicle_id",
        temp.alias("temp"),
        F.col("speeding_events").alias("speeding"),
        severity.alias("severity"),
    )


def executive_kpis(driver_mart: DataFrame, vehicle_mart: DataFrame) -> DataFrame:
    """Newest-day figures, zeros when there are none.

    The vehicle figure is taken on the newest day of the *driver* mart.
    """
    speeding = (
        vehicle_mart.where(F.col("date_key") == latest_day(driver_mart))
        .select(F.sum("speeding_events").alias("speeding"))
        .scalar()
    )
    return latest(driver_mart).agg(
        F.count_distinct("driver_id").alias("active_drivers"),
        F.coalesce(F.avg("avg_fatigue_index"), F.lit(0.0)).alias("avg_fatigue_index"),
        F.coalesce(F.sum("net_profit"), F.lit(0.0)).alias("net_profit"),
        F.coalesce(F.sum("fraud_alerts_count"), F.lit(0)).alias("fraud_alerts"),
    ).withColumn("total_speeding_events", F.coalesce(speeding, F.lit(0)))


def profit_trend(driver_mart: DataFrame, days: int = 7) -> DataFrame:
    return (
        trailing(driver_mart, days)
        .groupBy("date_key").agg(F.sum("net_profit").alias("profit"))
        .orderBy("date_key")
    )


def safety_trend(vehicle_mart: DataFrame, thresholds: DataFrame, days: int = 7) -> DataFrame:
    """Speeding events and overheating vehicles per day."""
    limit = threshold(thresholds, "engine_temp_c", default=TEMP_FALLBACK)
    return (
        trailing(vehicle_mart, days)
        # compared per row, ahead of the aggregate: a subquery cannot sit inside one
        .withColumn("hot", F.col("avg_engine_temp_c") > limit)
        .groupBy("date_key")
        .agg(F.sum("speeding_events").alias("speeding"), F.count_if(F.col("hot")).alias("overheating"))
        .orderBy("date_key")
    )


def risky_drivers(driver_mart: DataFrame, thresholds: DataFrame, k: int = 5) -> DataFrame:
    """Top drivers of the newest day that need attention."""
    warn = threshold(thresholds, "avg_fatigue_index", default=FATIGUE_FALLBACK)
    risky = (
        (F.col("avg_fatigue_index") > warn)
        | (F.col("speeding_events") > 5)
        | (F.col("fraud_alerts_count") > 0)
    )
    return (
        latest(driver_mart).where(risky)
        .select(
            "driver_id",
            F.round("avg_fatigue_index", 2).alias("fatigue"),
            F.col("speeding_events").alias("speeding"),
            F.col("fraud_alerts_count").alias("fraud"),
        )
        .orderBy(F.desc("fatigue"), "driver_id")
        .limit(k)
    )


def _activity(events: str) -> Column:
    return F.when(F.col(events) > 0, F.lit("Active")).otherwise(F.lit("Idle/Ghost"))


def asset_status(vehicle_mart: DataFrame) -> DataFrame:
    """Vehicles with and without events among the mart rows of the newest day."""
    return (
        latest(vehicle_mart)
        .groupBy(_activity("telemetry_events").alias("status"))
        .agg(F.count("vehicle_id").alias("count"))
    )


def asset_status_all(dim_vehicle: DataFrame, vehicle_mart: DataFrame) -> DataFrame:
    """As :func:`asset_status`, over every vehicle of the dimension."""
    today = latest(vehicle_mart).select("vehicle_id", "telemetry_events")
    return (
        dim_vehicle.select("vehicle_id").join(today, "vehicle_id", "left")
        .groupBy(_activity("telemetry_events").alias("status"))
        .agg(F.count("vehicle_id").alias("count"))
    )


def kpi_labels(kpis: DataFrame, thresholds: DataFrame, vehicle_mart: DataFrame) -> DataFrame:
    """Executive figures with their labels."""
    warn = threshold(thresholds, "avg_fatigue_index", default=FATIGUE_FALLBACK)
    limit = threshold(thresholds, "engine_temp_c", default=TEMP_FALLBACK)
    overheating = overheating_count(vehicle_mart, limit).scalar()
    return kpis.withColumn("overheating", overheating).withColumns(
        {
            "fatigue_label": F.when(F.col("avg_fatigue_index") > warn, "Risk").otherwise("Normal"),
            "overheating_label": F.when(F.col("overheating") > 0, "Critical").otherwise("Clear"),
            "fraud_label": F.when(F.col("fraud_alerts") > 0, "Review").otherwise("OK"),
        }
    )


def finance_labels(kpis: DataFrame) -> DataFrame:
    label = F.when(F.col("fraud_alerts") > 5, "High Risk").otherwise("Normal")
    return kpis.withColumn("fraud_label", label)


def quality_labels(health: DataFrame) -> DataFrame:
    return health.withColumns(
        {
            "lag_label": F.when(F.col("days_lag") == 0, "Optimal").otherwise("Behind"),
            "leads_label": F.when(F.col("leads") > 0, "Risk Detected").otherwise("Clear"),
            "nulls_label": F.when(F.col("null_keys") == 0, "Clean").otherwise("Error"),
        }
    )
