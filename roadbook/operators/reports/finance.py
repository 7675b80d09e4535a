"""Finance and compliance page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from roadbook.functions.expressions import date_range


def finance_kpis(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Totals and the margin in percent; a margin of zero without revenue."""
    totals = date_range(driver_mart, start, end).agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_cost").alias("total_cost"),
        F.sum("net_profit").alias("net_profit"),
        F.sum("fraud_alerts_count").alias("fraud_alerts"),
    )
    margin = F.when(
        F.col("total_revenue") > 0, F.try_divide("net_profit", "total_revenue") * 100
    ).otherwise(F.lit(0.0))
    return totals.withColumn("margin_pct", margin)


def revenue_cost_trend(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        date_range(driver_mart, start, end)
        .groupBy("date_key")
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_cost").alias("cost"))
        .orderBy("date_key")
    )


def fraud_trend(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        date_range(driver_mart, start, end)
        .groupBy("date_key").agg(F.sum("fraud_alerts_count").alias("alerts"))
        .orderBy("date_key")
    )


def risk_reward(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return date_range(driver_mart, start, end).groupBy("driver_id").agg(
        F.sum("net_profit").alias("total_profit"),
        F.sum("fraud_alerts_count").alias("total_fraud"),
        F.avg("avg_fatigue_index").alias("avg_fatigue"),
    )


def loss_makers(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Drivers with a loss, worst first."""
    return (
        date_range(driver_mart, start, end)
        .groupBy("driver_id")
        .agg(F.sum("net_profit").alias("profit"), F.sum("total_revenue").alias("rev"))
        .where(F.col("profit") < 0)
        .orderBy("profit", "driver_id")
    )


def high_fraud(driver_mart: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Drivers with fraud signals, most first."""
    return (
        date_range(driver_mart, start, end)
        .groupBy("driver_id")
        .agg(F.sum("fraud_alerts_count").alias("alerts"), F.avg("avg_fatigue_index").alias("fatigue"))
        .where(F.col("alerts") > 0)
        .orderBy(F.desc("alerts"), "driver_id")
    )
