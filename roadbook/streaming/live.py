"""Stateless alerts and windowed aggregates on the telemetry stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from roadbook import schemas
from roadbook.operators import marts, upserts
from roadbook.operators.alerts import ALERT_COLUMNS, evaluate_thresholds
from roadbook.operators.conform import align
from roadbook.plans import warehouse
from roadbook.sources import tables

# Threshold name -> telemetry column.
SAMPLE_METRICS = {"engine_temp_c": "engine_temp_c", "battery_voltage": "battery_v"}


def stream_vehicle_daily(df: DataFrame, delay: str = "1 day") -> DataFrame:
    """One-day tumbling figures per vehicle; partial aggregation runs ahead of the state store.

    Run it in update mode with :func:`keep_vehicle_daily`: a batch then gives the vehicle-days it
    changed, and the watermark frees the state of days that are over.
    """
    return (
        df.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", "1 day"), "vehicle_id")
        .agg(*[F.expr(m) for m in marts.VEHICLE_MEASURES])
        .withColumn("date_key", F.to_date("window.start"))
        .drop("window")
    )


def keep_vehicle_daily(root: str) -> Callable[[DataFrame, int], None]:
    """Put the vehicle-days of a batch in place of the stored ones; only their days are rewritten."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, "live_vehicle_daily"
        warehouse.recover_swaps(spark, root, name)
        changed = tables.materialize(align(batch, schemas.TABLES[name]), name)
        days = tables.days_of(changed)
        if days:
            stored = tables.read_table(spark, root, name).where(F.col("date_key").isin(days))
            kept = upserts.delete_keys(stored, changed, marts.VEHICLE_DAY)
            warehouse.swap_days(spark, root, name, kept.unionByName(changed), days)

    return on_batch


def stream_alerts(df: DataFrame, thresholds: DataFrame, dim_vehicle: DataFrame) -> DataFrame:
    """Samples of active vehicles over a limit, against the static rules and dimension."""
    active = dim_vehicle.where(F.col("status") == "ACTIVE").select("vehicle_id")
    wide = df.join(active, "vehicle_id").select(
        F.col("vehicle_id").alias("entity_id"),
        "event_id",
        "event_timestamp",
        *[F.col(column).cast("double").alias(name) for name, column in SAMPLE_METRICS.items()],
    )
    keys = ["entity_id", "event_id", "event_timestamp"]
    long = wide.unpivot(keys, list(SAMPLE_METRICS), "metric_name", "metric_value").withColumn(
        "entity_type", F.lit("vehicle")
    )
    return evaluate_thresholds(long, thresholds, inclusive=True, keep=keys[1:]).select(
        *ALERT_COLUMNS, *keys[1:]
    )


def keep_alerts(root: str, out: str) -> Callable[[DataFrame, int], None]:
    """Alerts of each batch against the limits and the vehicles that are published when it runs.

    A stream that joins a table keeps to the version it has started with, so here the tables are looked up by batch. A
    repeated batch replaces its own alerts, judged by what holds then. Read them with ``tables.read_versions``.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules, vehicles = (tables.read_current(spark, root, name) for name in ("alert_thresholds", "dim_vehicle"))
        tables.replace_table(stream_alerts(batch, rules, vehicles), out, version=batch_id + 1)

    return on_batch
