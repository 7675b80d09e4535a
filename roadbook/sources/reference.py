"""Small reference data: calendar, master lists, thresholds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

# The seed rows of the threshold table.
# metric_name, warning, critical, comparison, description, active
THRESHOLD_SEED = [
    ("avg_fatigue_index", 0.6, 0.8, ">", "Driver fatigue risk", True),
    ("speeding_rate", 0.08, 0.12, ">", "High speeding frequency", True),
    ("engine_temp_c", 90.0, 120.0, ">", "Engine overheating risk", True),
    ("battery_voltage", 11.8, 11.2, "<", "Low vehicle battery", True),
    ("fraud_alerts_count", 1.0, 3.0, ">", "Potential fraud detected", True),
]


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def date_spine_over(df: DataFrame, date_col: str) -> DataFrame:
    """Every calendar day between the first and the last date of a column."""
    day = F.to_date(date_col)
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))
    return span.select(F.explode(days).alias("date_key"))


def stage_master(df: DataFrame, id_col: str) -> DataFrame:
    """Master list with the derived activity switch."""
    return df.select(id_col, "status", (F.col("status") == "ACTIVE").alias("is_active"))


def default_thresholds(spark: SparkSession) -> DataFrame:
    """Seed thresholds as a local relation, so no job is needed to read them."""
    rows = ", ".join(
        f"('{name}', {warn}D, {crit}D, '{op}', '{text}', {str(active).lower()})"
        for name, warn, crit, op, text, active in THRESHOLD_SEED
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS seed(metric_name, warning_threshold, "
        "critical_threshold, comparison_op, description, is_active)"
    )
