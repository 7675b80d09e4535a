"""Alerts, digest, data quality, per-sample signals, report text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks.binding import AS_OF, ALERT_TIME, Fleet
from checks.oracle import DRIVER_MART, rounded, sql
from roadbook import schemas
from roadbook.functions import text
from roadbook.operators import alerts, quality
from roadbook.session import scratch_path
from roadbook.sources import tables

# The limits in the SQL below are those of the rules it checks.
_ALERT = "entity_id, entity_type, metric_name, metric_value, severity, description"

_FATIGUE = """
    SELECT driver_id AS entity_id, 'driver' AS entity_type, 'avg_fatigue_index' AS metric_name,
           round(avg_fatigue_index, 1) AS metric_value,
           CASE WHEN avg_fatigue_index >= 0.8e0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'Driver fatigue risk' AS description
    FROM dlast JOIN drv USING (driver_id) WHERE status = 'ACTIVE' AND avg_fatigue_index >= 0.6e0"""
_VEHICLE = """
    SELECT vehicle_id AS entity_id, 'vehicle' AS entity_type, 'engine_temp' AS metric_name, round(avg_engine_temp_c, 6) AS metric_value,
           CASE WHEN avg_engine_temp_c >= 120 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'Engine overheating risk' AS description
    FROM vlast WHERE avg_engine_temp_c >= 90"""
_FRAUD = """
    SELECT driver_id AS entity_id, 'driver' AS entity_type, 'fraud_alerts' AS metric_name, CAST(fraud_alerts_count AS DOUBLE) AS metric_value,
           'CRITICAL' AS severity, 'Fraud signals detected' AS description FROM dlast WHERE fraud_alerts_count > 0"""


def _freshness(mart: str) -> str:
    return f"""
    SELECT 'SYSTEM' AS entity_id, 'system' AS entity_type, 'data_freshness_days_lag' AS metric_name, CAST(lag AS DOUBLE) AS metric_value,
           'WARNING' AS severity, 'Data freshness SLA breach for active fleet' AS description
    FROM (SELECT (SELECT max(date_key) FROM {mart}) - max(date_key) AS lag FROM {mart}
          WHERE driver_id IN (SELECT driver_id FROM drv WHERE status = 'ACTIVE')) WHERE lag > 1"""


def _stale(f: Fleet) -> DataFrame:
    """The mart with the days of active drivers moved three days back, so that they lag."""
    active = f.driver_master.where(F.col("status") == "ACTIVE").select("driver_id", F.lit(True).alias("active"))
    moved = F.when(F.col("active"), F.date_sub("date_key", 3)).otherwise(F.col("date_key"))
    return f.driver_mart.join(active, "driver_id", "left").withColumn("date_key", moved).drop("active")


_STALE = """
    SELECT * REPLACE (CASE WHEN driver_id IN (SELECT driver_id FROM drv WHERE status = 'ACTIVE')
                           THEN date_key - 3 ELSE date_key END AS date_key) FROM dm"""


def _all(f: Fleet) -> DataFrame:
    """The rules read stored marts, as in the daily run."""
    return alerts.all_alerts(f.stored_driver_mart, f.stored_vehicle_mart, f.driver_master, f.thresholds, ALERT_TIME)


_ALL = f"""
    SELECT 'driver_fatigue' AS alert_name, * FROM ({_FATIGUE}) UNION ALL SELECT 'vehicle_risk', * FROM ({_VEHICLE})
    UNION ALL SELECT 'fraud', * FROM ({_FRAUD}) UNION ALL SELECT 'data_freshness', * FROM ({_freshness('dm')})"""


def alert_thresholds_generic(f: Fleet) -> DataFrame:
    """Every threshold against every mart row of every day."""
    long = alerts.metrics_long(f.driver_mart, "driver_id", "driver", alerts.DRIVER_METRICS).unionByName(
        alerts.metrics_long(f.vehicle_mart, "vehicle_id", "vehicle", alerts.VEHICLE_METRICS)
    )
    return alerts.evaluate_thresholds(long, f.thresholds)


def write_alerts(f: Fleet) -> DataFrame:
    """Two evaluations stored in the alert table, one of them twice, and read back."""
    root = scratch_path(f.spark, "alerts")
    path = tables.table_path(root, "alerts")
    fraud = alerts.alert_fraud(f.driver_mart).withColumn("alert_name", F.lit("fraud"))
    tables.write_alerts(fraud, path, ALERT_TIME)
    tables.write_alerts(fraud, path, ALERT_TIME + dt.timedelta(days=1))
    tables.write_alerts(fraud, path, ALERT_TIME)
    return tables.read_table(f.spark, root, "alerts")


def alert_digest(f: Fleet) -> DataFrame:
    """The digest reads evaluated alerts, so the rules run once."""
    rounded_alerts = _all(f).withColumn("metric_value", F.round("metric_value", 6))
    return alerts.alert_digest(tables.materialize(rounded_alerts, "alerts"))


def harsh_brake(f: Fleet) -> DataFrame:
    return alerts.harsh_brake(f.telemetry).select("event_id", "vehicle_id", "prev_speed_kph", "harsh_brake")


def shift_signals(f: Fleet) -> DataFrame:
    return alerts.shift_signals(f.shifts).select("event_id", "breaks_taken", "alerts")


def report_text(f: Fleet) -> DataFrame:
    """Every formatter over the driver mart, the dimension timestamps included."""
    dim = f.dim_driver.select("driver_id", "last_seen_at")
    some = F.when(F.col("total_events") > 0, F.col("avg_fatigue_index"))
    return f.driver_mart.join(dim, "driver_id").select(
        "driver_id", "date_key",
        text.percentage(some).alias("pct"),
        text.fixed("avg_fatigue_index", 3).alias("fatigue3"),
        text.fatigue(some).alias("fatigue2"),
        text.integer(F.col("total_events") * 12345).alias("events"),
        text.currency("max_continuous_hours").alias("money"),
        text.hours("total_shift_hours").alias("shift"),
        text.temperature(F.col("total_shift_hours") * 4.5).alias("temp"),
        text.short_time("last_seen_at").alias("seen"),
        text.activity_time("last_seen_at").alias("activity"),
    )


def severity_rank(f: Fleet) -> DataFrame:
    """Order priorities read as untidy severity words."""
    word = (
        F.when(F.col("o_orderpriority").startswith("1"), F.lit(" critical "))
        .when(F.col("o_orderpriority").startswith("2"), F.lit("Warning"))
        .when(F.col("o_orderpriority").startswith("3"), F.lit("info"))
        .when(F.col("o_orderpriority").startswith("4"), F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority"))
    )
    return f.table("orders").select(
        "o_orderkey", text.normalize_severity(word).alias("severity"), text.severity_rank(word).alias("rank")
    )


_D = rounded(DRIVER_MART)
_LEADS = """
    SELECT 'Vehicle' AS category, vehicle_id AS entity_id, 'High Temp' AS issue_type,
           CAST(round(avg_engine_temp_c, 1) AS VARCHAR) || '°C' AS value FROM vlast WHERE avg_engine_temp_c > 90
    UNION ALL SELECT 'Driver', driver_id, 'High Fatigue', CAST(round(avg_fatigue_index, 2) AS VARCHAR)
    FROM dlast WHERE avg_fatigue_index > 0.6e0"""

QUERIES = {
    "alert_fatigue": (
        lambda f: alerts.alert_fatigue(f.driver_mart, f.driver_master, f.thresholds), sql(_FATIGUE, "dlast", "drv"),
    ),
    "alert_vehicle_risk": (lambda f: alerts.alert_vehicle_risk(f.vehicle_mart, f.thresholds), sql(_VEHICLE, "vlast")),
    "alert_fraud": (lambda f: alerts.alert_fraud(f.driver_mart), sql(_FRAUD, "dlast")),
    "alert_freshness": (
        lambda f: alerts.alert_freshness(_stale(f), f.driver_master),
        sql(_freshness("stale"), "dm", "drv", stale=_STALE),
    ),
    "alert_vehicle_static": (
        lambda f: alerts.alert_vehicle_static(f.vehicle_mart),
        sql("""SELECT vehicle_id AS entity_id, 'vehicle' AS entity_type, 'vehicle_risk' AS metric_name,
                      round(avg_engine_temp_c, 6) AS metric_value,
                      CASE WHEN avg_engine_temp_c > 100 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
                      'Engine temp or speeding anomaly' AS description
               FROM vlast WHERE avg_engine_temp_c > 95 OR speeding_rate > 0.10e0""", "vlast"),
    ),
    "alert_no_activity_empty": (
        # the mart of the days after the newest one
        lambda f: alerts.alert_no_activity(f.driver_mart.where(F.col("date_key") > F.lit(f.span[1]))),
        sql("""SELECT 'SYSTEM' AS entity_id, 'system' AS entity_type, 'no_driver_activity' AS metric_name, 0e0 AS metric_value,
                      'CRITICAL' AS severity, 'No active drivers today' AS description
               FROM (SELECT count(DISTINCT driver_id) AS n FROM dm WHERE date_key > (SELECT CAST(max(ts) AS DATE) FROM events)) WHERE n = 0""", "dm"),
    ),
    "alert_no_activity": (
        lambda f: alerts.alert_no_activity(f.driver_mart),
        sql("""SELECT 'SYSTEM' AS entity_id, 'system' AS entity_type, 'no_driver_activity' AS metric_name, 0e0 AS metric_value,
                      'CRITICAL' AS severity, 'No active drivers today' AS description
               FROM (SELECT count(*) AS n FROM dm) WHERE n = 0""", "dm"),
    ),
    "alert_thresholds_generic": (
        alert_thresholds_generic,
        sql("""SELECT entity_id, entity_type, metric_name, round(v, 6) AS metric_value,
                      CASE WHEN comparison_op = '>' AND v > critical_threshold OR comparison_op = '<' AND v < critical_threshold
                           THEN 'CRITICAL' ELSE 'WARNING' END AS severity, description, date_key
               FROM (SELECT driver_id AS entity_id, 'driver' AS entity_type, 'avg_fatigue_index' AS metric_name, avg_fatigue_index AS v, date_key FROM dm
                     UNION ALL SELECT driver_id, 'driver', 'fraud_alerts_count', fraud_alerts_count, date_key FROM dm
                     UNION ALL SELECT vehicle_id, 'vehicle', 'speeding_rate', speeding_rate, date_key FROM vm
                     UNION ALL SELECT vehicle_id, 'vehicle', 'engine_temp_c', avg_engine_temp_c, date_key FROM vm
                     UNION ALL SELECT vehicle_id, 'vehicle', 'battery_voltage', avg_battery_voltage, date_key FROM vm)
               JOIN thr USING (metric_name)
               WHERE comparison_op = '>' AND v > warning_threshold OR comparison_op = '<' AND v < warning_threshold""", "dm", "vm", "thr"),
    ),
    "all_alerts": (
        _all,
        sql(f"SELECT alert_name, {_ALERT}, TIMESTAMP '2024-01-31 06:00:00' AS alert_time FROM ({_ALL})", "dlast", "vlast", "drv"),
    ),
    "write_alerts": (
        write_alerts,
        sql(f"""SELECT 'fraud' AS alert_name, {_ALERT}, TIMESTAMP '2024-01-31 06:00:00' + to_days(CAST(d AS INTEGER)) AS alert_time
                FROM ({_FRAUD}), (VALUES (0), (1)) AS t(d)""", "dlast"),
    ),
    "alert_digest": (
        alert_digest,
        sql("""SELECT alert_name, total, total || ' alert(s) detected' AS headline,
                      string_agg(severity || ' | Entity: ' || entity_id || ' | Metric: ' || metric_name || ' = '
                                 || CAST(metric_value AS VARCHAR) || ' | Info: ' || description, chr(10) ORDER BY position) AS body,
                      CASE WHEN total > 5 THEN 'Showing 5 of ' || total || '. See dashboard for full details.' END AS note
               FROM (SELECT *, count(*) OVER (PARTITION BY alert_name) AS total,
                            row_number() OVER (PARTITION BY alert_name ORDER BY (severity = 'CRITICAL') DESC, metric_value DESC, entity_id) AS position
                     FROM alerts) WHERE position <= 5 GROUP BY alert_name, total""", "dlast", "vlast", "drv", alerts=_ALL),
    ),
    "alert_timeline": (
        lambda f: alerts.alert_timeline(_all(f)),
        sql("SELECT TIMESTAMP '2024-01-31 06:00:00' AS alert_time, entity_id, severity, metric_name, metric_value, description "
            "FROM alerts", "dlast", "vlast", "drv", alerts=_ALL),
    ),
    "harsh_brake": (
        harsh_brake,
        sql("""SELECT event_id, vehicle_id, round(prev, 6) AS prev_speed_kph,
                      coalesce(prev - speed_kph > greatest(8, prev * 0.25e0), FALSE) AS harsh_brake
               FROM (SELECT *, lag(speed_kph) OVER (PARTITION BY vehicle_id ORDER BY event_timestamp, event_id) AS prev FROM tel)""", "tel"),
    ),
    "replay_buffer": (
        lambda f: alerts.replay_buffer(f.telemetry).select("vehicle_id", "event_id", "event_timestamp", "speed_kph", "recency"),
        sql("""SELECT vehicle_id, event_id, event_timestamp, round(speed_kph, 6) AS speed_kph, CAST(rn AS INTEGER) AS recency
               FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM tel)
               WHERE rn <= 30""", "tel"),
    ),
    "shift_signals": (
        shift_signals,
        sql("""SELECT event_id, fatigue_index < 0.6e0 AS breaks_taken,
                      CASE WHEN fatigue_index >= 0.6e0 THEN ['fatigue_risk'] ELSE CAST([] AS VARCHAR[]) END AS alerts FROM shf""", "shf"),
    ),
    "speeding_flag": (
        lambda f: alerts.speeding_flag(f.telemetry.drop("speeding")).select("event_id", "speeding"),
        sql("SELECT event_id, speed_kph > 50 AS speeding FROM tel", "tel"),
    ),
    "dq_nulls": (
        # driver mart widened to all drivers: those without a day have a null key
        lambda f: quality.dq_nulls(f.driver_master.join(f.driver_mart, "driver_id", "left"), ["driver_id", "date_key"]),
        sql("SELECT count(*) AS bad_rows FROM drv LEFT JOIN dm USING (driver_id) WHERE date_key IS NULL", "drv", "dm"),
    ),
    "orphans": (
        lambda f: quality.orphans(f.telemetry, f.driver_master.where(F.col("status") == "ACTIVE")),
        sql("SELECT driver_id, count(*) AS fact_rows FROM tel WHERE driver_id NOT IN "
            "(SELECT driver_id FROM drv WHERE status = 'ACTIVE') GROUP BY driver_id", "tel", "drv"),
    ),
    "dq_ranges": (
        lambda f: quality.dq_ranges(f.driver_mart),
        sql(f"SELECT {_D} FROM dlast WHERE avg_speed_kph > 180 OR total_shift_hours > 24 OR max_continuous_hours > 12 "
            "OR avg_fatigue_index > 1 OR net_profit < -1000", "dlast"),
    ),
    "dq_ranges_all_days": (
        lambda f: quality.dq_ranges(f.driver_mart, latest_only=False),
        sql(f"SELECT {_D} FROM dm WHERE avg_speed_kph > 180 OR total_shift_hours > 24 OR max_continuous_hours > 12 "
            "OR avg_fatigue_index > 1 OR net_profit < -1000", "dm"),
    ),
    "dq_freshness": (
        lambda f: quality.dq_freshness(f.driver_mart, AS_OF),
        sql("""SELECT max(date_key) AS latest_data_point, CAST(DATE '2024-01-31' - max(date_key) AS INTEGER) AS days_of_lag,
                      CASE WHEN DATE '2024-01-31' - max(date_key) > 1 THEN 'OUTDATED' ELSE 'FRESH' END AS status FROM dm""", "dm"),
    ),
    "ghost_assets": (
        lambda f: quality.ghost_assets(f.dim_vehicle),
        sql("SELECT count(*) FILTER (WHERE last_seen_at IS NULL) AS ghost_count FROM vdim", "vdim"),
    ),
    "investigation_leads": (
        lambda f: quality.investigation_leads(f.stored_vehicle_mart, f.stored_driver_mart, f.thresholds), sql(_LEADS, "vlast", "dlast"),
    ),
    "health_score": (
        lambda f: quality.system_health(f.vehicle_mart, f.driver_mart, f.thresholds, AS_OF),
        sql("""SELECT *, CASE WHEN days_lag > 3 OR leads > 10 THEN 'Critical' WHEN days_lag > 1 OR leads > 0 THEN 'Degraded'
                              ELSE 'Healthy' END AS health
               FROM (SELECT CAST(DATE '2024-01-31' - max(date_key) AS INTEGER) AS days_lag, count(*) FILTER (WHERE vehicle_id IS NULL) AS null_keys,
                            max(date_key) AS last_data_date, (SELECT count(*) FROM leads) AS leads FROM vm)""",
            "vm", "vlast", "dlast", leads=_LEADS),
    ),
    "ingestion_volume": (
        lambda f: quality.ingestion_volume(f.vehicle_mart),
        sql("SELECT date_key, count(*) AS record_count FROM vm GROUP BY date_key ORDER BY date_key DESC LIMIT 14", "vm"),
    ),
    "row_count": (lambda f: quality.row_count(f.dim_driver), sql("SELECT count(*) AS row_count FROM drv", "drv")),
    "severity_rank": (
        severity_rank,
        """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'CRITICAL' WHEN '2' THEN 'WARNING' WHEN '3' THEN 'INFO'
                                                            WHEN '4' THEN 'INFO' ELSE upper(o_orderpriority) END AS severity,
                  CAST(CASE left(o_orderpriority, 1) WHEN '1' THEN 2 WHEN '2' THEN 1 WHEN '3' THEN 0 WHEN '4' THEN 0 END AS INTEGER) AS rank
           FROM orders""",
    ),
    "report_text": (
        report_text,
        sql("""SELECT dm.driver_id, date_key,
                      CASE WHEN total_events > 0 THEN printf('%.1f', avg_fatigue_index * 100) || '%' ELSE '—' END AS pct,
                      printf('%.3f', avg_fatigue_index) AS fatigue3,
                      CASE WHEN total_events > 0 THEN printf('%.2f', avg_fatigue_index) ELSE '—' END AS fatigue2,
                      format('{:,}', total_events * 12345) AS events, '$' || format('{:,.2f}', max_continuous_hours) AS money,
                      printf('%.1f', total_shift_hours) || ' hrs' AS shift, printf('%.1f', total_shift_hours * 4.5e0) || '°C' AS temp,
                      coalesce(strftime(last_seen_at, '%d %b %H:%M'), 'NEVER') AS seen,
                      coalesce(strftime(last_seen_at, '%Y-%m-%d %H:%M'), 'NEVER REPORTED') AS activity
               FROM dm JOIN ddim ON dm.driver_id = ddim.driver_id""", "dm", "ddim"),
    ),
}
