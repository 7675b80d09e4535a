"""Marts, key sets, refresh and trip roll-ups."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from checks.binding import Fleet
from checks.oracle import CTES, DRIVER_MART, VEHICLE_MART, rounded, sql
from roadbook import schemas
from roadbook.functions.expressions import high_water
from roadbook.operators import alerts, marts, staging, upserts
from roadbook.operators.conform import to_fact
from roadbook.sources.raw import read_raw


def _first_driver_mart(f: Fleet) -> DataFrame:
    return marts.driver_daily_metrics(
        f.early("telemetry"), f.early("shifts"), f.early("finance"), f.driver_master
    )


def _first_vehicle_mart(f: Fleet) -> DataFrame:
    return marts.vehicle_daily_metrics(f.early("telemetry"), f.thresholds)


def refresh_driver_high_watermark(f: Fleet) -> DataFrame:
    return marts.refresh_driver(
        _first_driver_mart(f), f.telemetry, f.shifts, f.finance, f.driver_master
    )


def refresh_driver_touched_keys(f: Fleet) -> DataFrame:
    touched = marts.changed_driver_days(f.late("telemetry"), f.late("shifts"), f.late("finance"))
    return marts.refresh_driver(
        _first_driver_mart(f), f.telemetry, f.shifts, f.finance, f.driver_master,
        policy="touched_keys", touched=touched,
    )


def refresh_vehicle_high_watermark(f: Fleet) -> DataFrame:
    return marts.refresh_vehicle(_first_vehicle_mart(f), f.telemetry, f.thresholds)


def refresh_vehicle_touched_keys(f: Fleet) -> DataFrame:
    touched = marts.changed_vehicle_days(f.late("telemetry"))
    return marts.refresh_vehicle(
        _first_vehicle_mart(f), f.telemetry, f.thresholds, policy="touched_keys", touched=touched
    )


def delete_keys(f: Fleet) -> DataFrame:
    """Driver-days without a finance record."""
    return upserts.delete_keys(f.driver_mart, marts.changed_driver_days(f.finance), marts.DRIVER_DAY)


def changed_driver_days(f: Fleet) -> DataFrame:
    """Driver-days after the first load's newest day."""
    mark = high_water(_first_driver_mart(f))
    return marts.changed_driver_days(f.telemetry, f.shifts, f.finance, mark=mark)


def changed_vehicle_days(f: Fleet) -> DataFrame:
    return marts.changed_vehicle_days(f.telemetry, mark=high_water(_first_vehicle_mart(f)))


def restrict(f: Fleet) -> DataFrame:
    """Telemetry of the driver-days that have a shift report, counted per vehicle."""
    kept = marts.restrict(f.telemetry, marts.changed_driver_days(f.shifts), marts.DRIVER_DAY)
    return kept.groupBy("vehicle_id").agg(F.count("*").alias("events"), F.max("event_id").alias("last_event"))


def threshold_row(f: Fleet) -> DataFrame:
    """Pivot of a threshold table learned from the mart: the highest value of each metric."""
    learned = alerts.metrics_long(f.vehicle_mart, "vehicle_id", "vehicle", alerts.VEHICLE_METRICS)
    return marts.threshold_row(
        learned.groupBy("metric_name").agg(F.max("metric_value").alias("warning_threshold"))
    )


def _finance(f: Fleet) -> DataFrame:
    return read_raw(f.spark, f.lake("finance"), schemas.RAW_FINANCE)


def _trips(records: DataFrame) -> DataFrame:
    return staging.stage_finance_trips(staging.explode_trips(records))


def reconcile_finance(f: Fleet) -> DataFrame:
    records = _finance(f)
    daily = to_fact(staging.stage_finance_daily(records), "date")
    return marts.reconcile_finance(daily, _trips(records))


# early load as CTEs: the same chain on the rows that arrived first
_EARLY_EV = """
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS date_key
    FROM events WHERE event_type <> 'error' AND CAST(ts AS DATE) <= DATE '2024-01-20'"""


def _renamed(names: list[str]) -> dict[str, str]:
    """The CTE chain once more on the early events, each name prefixed with ``e_``."""
    chain = {"e_ev": _EARLY_EV}
    for name in names:
        body = CTES[name]
        for below in ["ev", *names]:
            body = re.sub(rf"\b(FROM|JOIN) {below}\b", rf"\1 e_{below}", body)
        chain[f"e_{name}"] = body
    return chain


_EARLY_DRIVER = _renamed(["tel", "shf", "fin", "ta", "sa", "fa", "dm"])
_EARLY_VEHICLE = _renamed(["tel", "vm"])
_D, _V = rounded(DRIVER_MART), rounded(VEHICLE_MART)

# orders as finance days, trips numbered 1..n
_DAY = """
    SELECT o_orderkey, 'DR_' || CAST(o_custkey AS VARCHAR) AS driver_id, CAST(o_orderdate AS DATE) AS date_key,
           CAST(left(o_orderpriority, 1) AS INTEGER) AS n, o_orderstatus,
           floor(o_totalprice / CAST(left(o_orderpriority, 1) AS INTEGER)) + 0.25e0 AS share
    FROM orders"""
_TRIP = """
    SELECT d.*, i, i * 1.75e0 + 0.5e0 AS trip_cost, i = 3 AS fraud
    FROM day d, LATERAL (SELECT unnest(generate_series(1, d.n)) AS i) g"""

QUERIES = {
    "driver_daily_metrics": (lambda f: f.driver_mart, sql(f"SELECT {_D} FROM dm", "dm")),
    "vehicle_daily_metrics": (lambda f: f.vehicle_mart, sql(f"SELECT {_V} FROM vm", "vm")),
    "telemetry_agg": (
        lambda f: marts.telemetry_agg(f.telemetry),
        sql("SELECT * REPLACE (round(avg_speed_kph, 6) AS avg_speed_kph) FROM ta", "ta"),
    ),
    "shift_agg": (
        lambda f: marts.shift_agg(f.shifts),
        sql("SELECT * REPLACE (round(total_shift_hours, 6) AS total_shift_hours, "
            "round(avg_fatigue_index, 6) AS avg_fatigue_index) FROM sa", "sa"),
    ),
    "finance_agg": (
        lambda f: marts.finance_agg(f.finance),
        sql("SELECT * REPLACE (round(total_revenue, 6) AS total_revenue, round(total_cost, 6) AS total_cost, "
            "round(net_profit, 6) AS net_profit) FROM fa", "fa"),
    ),
    "threshold_row": (
        threshold_row,
        sql("SELECT round(max(avg_engine_temp_c), 6) AS temp_warn, round(max(avg_battery_voltage), 6) AS batt_warn, "
            "round(max(speeding_rate), 6) AS speed_warn FROM vm", "vm"),
    ),
    "high_water": (
        lambda f: f.driver_mart.agg(F.count("*").alias("mart_rows")).withColumn("mark", high_water(f.driver_mart)),
        sql("SELECT count(*) AS mart_rows, max(date_key) AS mark FROM dm", "dm"),
    ),
    "restrict": (
        restrict,
        sql("SELECT vehicle_id, count(*) AS events, max(event_id) AS last_event FROM tel "
            "WHERE EXISTS (SELECT 1 FROM shf WHERE shf.driver_id = tel.driver_id AND shf.date_key = tel.date_key) "
            "GROUP BY vehicle_id", "tel", "shf"),
    ),
    "changed_driver_days": (
        changed_driver_days,
        sql("SELECT DISTINCT driver_id, date_key FROM (SELECT driver_id, date_key FROM tel UNION ALL "
            "SELECT driver_id, date_key FROM shf UNION ALL SELECT driver_id, date_key FROM fin) "
            "WHERE date_key > DATE '2024-01-20'", "tel", "shf", "fin"),
    ),
    "changed_vehicle_days": (
        changed_vehicle_days,
        sql("SELECT DISTINCT vehicle_id, date_key FROM tel WHERE date_key > DATE '2024-01-20'", "tel"),
    ),
    "refresh_driver_high_watermark": (
        refresh_driver_high_watermark,
        sql(f"SELECT {_D} FROM e_dm UNION ALL SELECT {_D} FROM dm WHERE date_key > (SELECT max(date_key) FROM e_dm)",
            "dm", **_EARLY_DRIVER),
    ),
    "refresh_driver_touched_keys": (refresh_driver_touched_keys, sql(f"SELECT {_D} FROM dm", "dm")),
    "refresh_vehicle_high_watermark": (
        refresh_vehicle_high_watermark,
        sql(f"SELECT {_V} FROM e_vm UNION ALL SELECT {_V} FROM vm WHERE date_key > (SELECT max(date_key) FROM e_vm)",
            "vm", **_EARLY_VEHICLE),
    ),
    "refresh_vehicle_touched_keys": (refresh_vehicle_touched_keys, sql(f"SELECT {_V} FROM vm", "vm")),
    "delete_keys": (
        delete_keys,
        sql(f"SELECT {_D} FROM dm WHERE NOT EXISTS (SELECT 1 FROM fin WHERE fin.driver_id = dm.driver_id "
            "AND fin.date_key = dm.date_key)", "dm", "fin"),
    ),
    "rollup_trips": (
        lambda f: marts.rollup_trips(_trips(_finance(f))),
        sql("SELECT driver_id, date_key, round(sum(share), 2) AS total_revenue, round(sum(trip_cost), 2) AS total_cost, "
            "round(round(sum(share), 2) - round(sum(trip_cost), 2), 2) AS net_profit, "
            "count(*) FILTER (WHERE fraud) AS fraud_alerts_count FROM trip GROUP BY driver_id, date_key",
            day=_DAY, trip=_TRIP),
    ),
    "reconcile_finance": (
        reconcile_finance,
        # a day of status F carries no count, which stages as zero
        sql("""SELECT * FROM (
                 SELECT driver_id, date_key,
                        round(sum(round(share * n + CASE WHEN o_orderstatus = 'P' THEN 10 ELSE 0 END, 2)), 2) AS declared_revenue,
                        round(sum(n * (n + 1) * 0.875e0 + n * 0.5e0), 2) AS declared_cost,
                        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 WHEN n >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS declared_fraud
                 FROM day GROUP BY ALL)
               JOIN (SELECT driver_id, date_key, round(sum(share), 2) AS trip_revenue, round(sum(trip_cost), 2) AS trip_cost,
                            count(*) FILTER (WHERE fraud) AS trip_fraud FROM trip GROUP BY ALL) USING (driver_id, date_key)
               WHERE abs(declared_revenue - trip_revenue) > 0.005 OR abs(declared_cost - trip_cost) > 0.005
                  OR declared_fraud <> trip_fraud""", day=_DAY, trip=_TRIP),
    ),
}
