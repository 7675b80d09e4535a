"""Reports R1-R40 over the whole period; entity pages report on every entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.alert_queries import _all, _ALL, _LEADS
from checks.binding import AS_OF, Fleet
from checks.oracle import DRIVER_MART, rounded, sql
from roadbook.functions.expressions import date_range, threshold
from roadbook.operators import quality
from roadbook.operators.reports import drivers, finance, generic, overview, vehicles

# the whole period of the events, on both sides
_IN_SPAN = "date_key BETWEEN (SELECT CAST(min(ts) AS DATE) FROM events) AND (SELECT CAST(max(ts) AS DATE) FROM events)"
_VSUM = f"""
    SELECT veh.vehicle_id, count(DISTINCT date_key) AS active_days, coalesce(avg(avg_speed_kph), 0) AS avg_speed,
           coalesce(max(max_speed_kph), 0) AS max_speed, coalesce(avg(avg_engine_temp_c), 0) AS avg_engine_temp,
           coalesce(avg(avg_battery_voltage), 0) AS avg_battery, CAST(coalesce(sum(speeding_events), 0) AS BIGINT) AS total_speeding,
           count(date_key) = 0 AS is_ghost
    FROM veh LEFT JOIN vm ON veh.vehicle_id = vm.vehicle_id AND {_IN_SPAN} GROUP BY veh.vehicle_id"""
_VSUM_COLS = """vehicle_id, active_days, round(avg_speed, 6) AS avg_speed, max_speed, round(avg_engine_temp, 6) AS avg_engine_temp,
    round(avg_battery, 6) AS avg_battery, total_speeding, is_ghost"""
_DSUM = f"""
    SELECT driver_id, count(DISTINCT date_key) AS active_days, round(avg(avg_fatigue_index), 6) AS avg_fatigue,
           CAST(sum(speeding_events) AS BIGINT) AS total_speeding, max(max_continuous_hours) AS max_hours,
           CAST(sum(fraud_alerts_count) AS BIGINT) AS fraud_alerts FROM dm WHERE {_IN_SPAN} GROUP BY driver_id"""
_EXEC = """
    SELECT count(DISTINCT driver_id) AS active_drivers, round(coalesce(avg(avg_fatigue_index), 0), 6) AS avg_fatigue_index,
           round(coalesce(sum(net_profit), 0), 6) AS net_profit, CAST(coalesce(sum(fraud_alerts_count), 0) AS BIGINT) AS fraud_alerts,
           (SELECT CAST(coalesce(sum(speeding_events), 0) AS BIGINT) FROM vm
            WHERE date_key = (SELECT max(date_key) FROM dm)) AS total_speeding_events FROM dlast"""
_FIN = f"""
    SELECT round(sum(total_revenue), 6) AS total_revenue, round(sum(total_cost), 6) AS total_cost, round(sum(net_profit), 6) AS net_profit,
           CAST(sum(fraud_alerts_count) AS BIGINT) AS fraud_alerts,
           round(CASE WHEN sum(total_revenue) > 0 THEN sum(net_profit) / sum(total_revenue) * 100 ELSE 0 END, 6) AS margin_pct
    FROM dm WHERE {_IN_SPAN}"""


def _vehicle_summary(f: Fleet) -> DataFrame:
    return vehicles.vehicle_summary(f.vehicle_master, f.vehicle_mart, *f.span)


QUERIES = {
    "fleet_inventory": (
        lambda f: overview.fleet_inventory(f.dim_vehicle),
        sql("SELECT count(*) AS total_vehicles, count(*) FILTER (WHERE status = 'ACTIVE') AS active_count, "
            "count(*) FILTER (WHERE last_seen_at IS NULL) AS ghost_count FROM vdim", "vdim"),
    ),
    "readiness": (
        lambda f: overview.readiness(f.dim_vehicle),
        sql("SELECT count(*) AS total_vehicles, count(*) FILTER (WHERE status = 'ACTIVE') AS active_count, "
            "round(count(*) FILTER (WHERE status = 'ACTIVE') / count(*) * 100, 6) AS ready_pct FROM veh", "veh"),
    ),
    "latest_date": (lambda f: overview.latest_date(f.vehicle_mart), sql("SELECT max(date_key) AS latest_date FROM vm", "vm")),
    "overheating_count": (
        lambda f: overview.overheating_count(f.vehicle_mart),
        sql("SELECT count(DISTINCT vehicle_id) AS overheating FROM vlast WHERE avg_engine_temp_c > 100", "vlast"),
    ),
    "overheating_count_threshold": (
        lambda f: overview.overheating_count(f.vehicle_mart, threshold(f.thresholds, "engine_temp_c")),
        sql("SELECT count(DISTINCT vehicle_id) AS overheating FROM vlast WHERE avg_engine_temp_c > 90", "vlast"),
    ),
    "profit_today": (
        lambda f: overview.profit_today(f.driver_mart),
        sql("SELECT round(sum(net_profit), 6) AS net_profit FROM dlast", "dlast"),
    ),
    "status_distribution": (
        lambda f: overview.status_distribution(f.dim_driver), sql("SELECT status, count(*) AS count FROM drv GROUP BY status", "drv"),
    ),
    "driver_activity": (
        lambda f: overview.driver_activity(f.dim_driver),
        sql("SELECT driver_id, status AS current_status, coalesce(CAST(CAST(last_seen_at AS DATE) AS VARCHAR), 'N/A') AS last_activity FROM ddim", "ddim"),
    ),
    "issue_feed": (
        lambda f: overview.issue_feed(f.vehicle_mart),
        sql("""SELECT vehicle_id, round(avg_engine_temp_c, 6) AS temp, speeding_events AS speeding,
                      CASE WHEN avg_engine_temp_c > 110 THEN 'CRITICAL' ELSE 'WARNING' END AS severity
               FROM vlast WHERE avg_engine_temp_c > 100 OR speeding_events > 15""", "vlast"),
    ),
    "threshold": (
        # configured limit, and the fallback of a metric that is not configured
        lambda f: f.vehicle_mart.where(F.col("avg_engine_temp_c") > threshold(f.thresholds, "engine_temp_c", "critical", 105))
        .where(F.col("avg_fuel_percent") > threshold(f.thresholds, "fuel_percent", default=20)).select("vehicle_id", "date_key"),
        sql("SELECT vehicle_id, date_key FROM vm WHERE avg_engine_temp_c > 120 AND avg_fuel_percent > 20", "vm"),
    ),
    "executive_kpis": (lambda f: overview.executive_kpis(f.stored_driver_mart, f.stored_vehicle_mart), sql(_EXEC, "dlast", "vm")),
    "profit_trend": (
        lambda f: overview.profit_trend(f.driver_mart),
        sql("SELECT date_key, round(sum(net_profit), 6) AS profit FROM dm WHERE date_key >= (SELECT max(date_key) FROM dm) - 7 GROUP BY date_key", "dm"),
    ),
    "safety_trend": (
        lambda f: overview.safety_trend(f.vehicle_mart, f.thresholds),
        sql("""SELECT date_key, CAST(sum(speeding_events) AS BIGINT) AS speeding, count(*) FILTER (WHERE avg_engine_temp_c > 90) AS overheating
               FROM vm WHERE date_key >= (SELECT max(date_key) FROM vm) - 7 GROUP BY date_key""", "vm"),
    ),
    "risky_drivers": (
        lambda f: overview.risky_drivers(f.driver_mart, f.thresholds),
        sql("""SELECT driver_id, round(avg_fatigue_index, 2) AS fatigue, speeding_events AS speeding, fraud_alerts_count AS fraud FROM dlast
               WHERE avg_fatigue_index > 0.6e0 OR speeding_events > 5 OR fraud_alerts_count > 0
               ORDER BY fatigue DESC, driver_id LIMIT 5""", "dlast"),
    ),
    "asset_status": (
        lambda f: overview.asset_status(f.vehicle_mart),
        sql("SELECT CASE WHEN telemetry_events > 0 THEN 'Active' ELSE 'Idle/Ghost' END AS status, count(*) AS count FROM vlast GROUP BY 1", "vlast"),
    ),
    "asset_status_all": (
        lambda f: overview.asset_status_all(f.vehicle_master, f.vehicle_mart),
        sql("""SELECT CASE WHEN telemetry_events > 0 THEN 'Active' ELSE 'Idle/Ghost' END AS status, count(*) AS count
               FROM veh LEFT JOIN vlast USING (vehicle_id) GROUP BY 1""", "veh", "vlast"),
    ),
    "driver_summary": (lambda f: drivers.driver_summary(f.driver_mart, *f.span), sql(_DSUM, "dm")),
    "driver_summary_flags": (
        lambda f: drivers.driver_summary_flags(drivers.driver_summary(f.driver_mart, *f.span)),
        sql(f"""SELECT *, CASE WHEN avg_fatigue > 0.65e0 THEN 'Risk' ELSE 'Safe' END AS fatigue_label,
                       CASE WHEN max_hours > 8 THEN 'Violation' ELSE 'Compliant' END AS hours_label FROM ({_DSUM})""", "dm"),
    ),
    "driver_trend": (
        lambda f: drivers.driver_trend(f.driver_mart, *f.span),
        sql(f"SELECT driver_id, date_key AS date, round(avg_fatigue_index, 6) AS avg_fatigue_index, max_continuous_hours FROM dm WHERE {_IN_SPAN}", "dm"),
    ),
    "speeding_profile": (
        lambda f: drivers.speeding_profile(f.driver_mart, *f.span),
        sql(f"SELECT driver_id, date_key AS date, speeding_events FROM dm WHERE {_IN_SPAN}", "dm"),
    ),
    "audit_log": (
        lambda f: drivers.audit_log(f.driver_mart, *f.span),
        sql(f"""SELECT driver_id, date_key, round(avg_fatigue_index, 2) AS fatigue, max_continuous_hours AS shift_hrs, speeding_events AS speeding,
                       fraud_alerts_count AS fraud FROM dm
                WHERE {_IN_SPAN} AND (avg_fatigue_index > 0.7e0 OR max_continuous_hours > 8 OR speeding_events > 10 OR fraud_alerts_count > 0)""", "dm"),
    ),
    "vehicle_summary": (_vehicle_summary, sql(f"SELECT {_VSUM_COLS} FROM ({_VSUM})", "veh", "vm")),
    "vehicle_status": (
        lambda f: vehicles.vehicle_status(_vehicle_summary(f), f.thresholds),
        sql(f"""SELECT {_VSUM_COLS}, CASE WHEN avg_engine_temp >= 120 THEN 'critical' WHEN avg_engine_temp >= 90 THEN 'warning' ELSE 'normal' END AS engine_level,
                       CASE WHEN avg_engine_temp > 90 THEN 'OVERHEAT' ELSE 'Optimal' END AS engine_label,
                       CASE WHEN avg_battery < 11.8e0 THEN 'LOW' ELSE 'Healthy' END AS battery_label FROM ({_VSUM})""", "veh", "vm"),
    ),
    "maintenance": (
        lambda f: vehicles.maintenance(_vehicle_summary(f), f.thresholds),
        sql(f"""SELECT vehicle_id, round(avg_engine_temp, 6) AS avg_engine_temp, round(avg_battery, 6) AS avg_battery,
                       CASE WHEN avg_engine_temp >= 120 THEN 'CRITICAL OVERHEAT' ELSE 'Temperature Warning' END AS recommendation
                FROM ({_VSUM}) WHERE avg_engine_temp >= 90
                UNION ALL SELECT vehicle_id, round(avg_engine_temp, 6), round(avg_battery, 6), 'Electrical Warning' FROM ({_VSUM})
                WHERE avg_battery < 11.8e0""", "veh", "vm"),
    ),
    "engine_trend": (
        lambda f: vehicles.engine_trend(f.vehicle_mart, *f.span),
        sql(f"SELECT vehicle_id, date_key, round(avg_engine_temp_c, 6) AS avg_engine_temp_c FROM vm WHERE {_IN_SPAN}", "vm"),
    ),
    "stress_series": (
        lambda f: vehicles.stress_series(f.vehicle_mart, *f.span),
        sql(f"SELECT vehicle_id, date_key, speeding_rate, round(avg_speed_kph, 6) AS avg_speed_kph FROM vm WHERE {_IN_SPAN}", "vm"),
    ),
    "operational_log": (
        lambda f: vehicles.operational_log(f.vehicle_mart, *f.span),
        sql(f"""SELECT vehicle_id, date_key, round(avg_speed_kph, 6) AS avg_speed_kph, max_speed_kph, round(avg_engine_temp_c, 6) AS avg_engine_temp_c,
                       round(avg_battery_voltage, 6) AS avg_battery_voltage, speeding_events FROM vm WHERE {_IN_SPAN}""", "vm"),
    ),
    "finance_kpis": (lambda f: finance.finance_kpis(f.driver_mart, *f.span), sql(_FIN, "dm")),
    "revenue_cost_trend": (
        lambda f: finance.revenue_cost_trend(f.driver_mart, *f.span),
        sql(f"SELECT date_key, round(sum(total_revenue), 6) AS revenue, round(sum(total_cost), 6) AS cost FROM dm WHERE {_IN_SPAN} GROUP BY date_key", "dm"),
    ),
    "fraud_trend": (
        lambda f: finance.fraud_trend(f.driver_mart, *f.span),
        sql(f"SELECT date_key, CAST(sum(fraud_alerts_count) AS BIGINT) AS alerts FROM dm WHERE {_IN_SPAN} GROUP BY date_key", "dm"),
    ),
    "risk_reward": (
        lambda f: finance.risk_reward(f.driver_mart, *f.span),
        sql(f"""SELECT driver_id, round(sum(net_profit), 6) AS total_profit, CAST(sum(fraud_alerts_count) AS BIGINT) AS total_fraud,
                       round(avg(avg_fatigue_index), 6) AS avg_fatigue FROM dm WHERE {_IN_SPAN} GROUP BY driver_id""", "dm"),
    ),
    "loss_makers": (
        lambda f: finance.loss_makers(f.driver_mart, *f.span),
        sql(f"""SELECT driver_id, round(sum(net_profit), 6) AS profit, round(sum(total_revenue), 6) AS rev FROM dm WHERE {_IN_SPAN}
                GROUP BY driver_id HAVING sum(net_profit) < 0""", "dm"),
    ),
    "high_fraud": (
        lambda f: finance.high_fraud(f.driver_mart, *f.span),
        sql(f"""SELECT driver_id, CAST(sum(fraud_alerts_count) AS BIGINT) AS alerts, round(avg(avg_fatigue_index), 6) AS fatigue
                FROM dm WHERE {_IN_SPAN} GROUP BY driver_id HAVING sum(fraud_alerts_count) > 0""", "dm"),
    ),
    "status_hours": (
        lambda f: drivers.status_hours(f.driver_master, f.shifts),
        sql("""SELECT status, count(drv.driver_id) AS driver_count, count(DISTINCT drv.driver_id) AS distinct_drivers,
                      round(coalesce(sum(shift_hours), 0), 6) AS total_fleet_hours
               FROM drv LEFT JOIN shf ON shf.driver_id = drv.driver_id GROUP BY status""", "drv", "shf"),
    ),
    "entities": (
        lambda f: generic.entities(f.driver_mart, "driver_id"), sql("SELECT DISTINCT driver_id FROM dm", "dm"),
    ),
    "date_range": (
        lambda f: date_range(f.driver_mart, as_of=AS_OF),
        sql(f"SELECT {rounded(DRIVER_MART)} FROM dm WHERE date_key BETWEEN DATE '2024-01-24' AND DATE '2024-01-31'", "dm"),
    ),
    "severity_top": (
        lambda f: generic.severity_top(_all(f).where(F.col("alert_name") == "vehicle_risk").select("entity_id", "severity", "metric_value"), "metric_value"),
        sql("SELECT entity_id, severity, metric_value FROM alerts WHERE alert_name = 'vehicle_risk' ORDER BY metric_value DESC, entity_id LIMIT 10",
            "dlast", "vlast", "drv", alerts=_ALL),
    ),
    "histogram": (
        lambda f: generic.histogram(f.table("lineitem"), "l_quantity", 7),
        """SELECT CAST(bin AS INTEGER) AS bin, round(lo + (bin - 1) * (hi - lo) / 7, 6) AS bin_start, count(*) AS count
           FROM (SELECT least(floor((l_quantity - lo) / (hi - lo) * 7) + 1, 7) AS bin, lo, hi
                 FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)) GROUP BY ALL""",
    ),
    "fatigue_streaks": (
        lambda f: drivers.fatigue_streaks(f.driver_mart, limit=0.4, min_days=2),
        sql("""SELECT driver_id, min(date_key) AS first_day, max(date_key) AS last_day, count(*) AS days
               FROM (SELECT *, sum(fresh) OVER (PARTITION BY driver_id ORDER BY date_key) AS run
                     FROM (SELECT driver_id, date_key, CASE WHEN date_key - lag(date_key) OVER (PARTITION BY driver_id ORDER BY date_key) = 1
                                                            THEN 0 ELSE 1 END AS fresh FROM dm WHERE avg_fatigue_index > 0.4e0))
               GROUP BY driver_id, run HAVING count(*) >= 2""", "dm"),
    ),
    "top_earners": (
        lambda f: drivers.top_earners(f.driver_mart),
        sql("""SELECT driver_id, round(sum(net_profit), 6) AS profit FROM dm WHERE date_key >= (SELECT max(date_key) FROM dm) - 7
               GROUP BY driver_id ORDER BY profit DESC, driver_id LIMIT 5""", "dm"),
    ),
    "kpi_labels": (
        lambda f: overview.kpi_labels(overview.executive_kpis(f.stored_driver_mart, f.stored_vehicle_mart), f.thresholds, f.vehicle_mart),
        sql(f"""SELECT *, CASE WHEN avg_fatigue_index > 0.6e0 THEN 'Risk' ELSE 'Normal' END AS fatigue_label,
                       CASE WHEN overheating > 0 THEN 'Critical' ELSE 'Clear' END AS overheating_label,
                       CASE WHEN fraud_alerts > 0 THEN 'Review' ELSE 'OK' END AS fraud_label
                FROM ({_EXEC}), (SELECT count(DISTINCT vehicle_id) AS overheating FROM vlast WHERE avg_engine_temp_c > 90)""", "dlast", "vm", "vlast"),
    ),
    "finance_labels": (
        lambda f: overview.finance_labels(finance.finance_kpis(f.driver_mart, *f.span)),
        sql(f"SELECT *, CASE WHEN fraud_alerts > 5 THEN 'High Risk' ELSE 'Normal' END AS fraud_label FROM ({_FIN})", "dm"),
    ),
    "quality_labels": (
        lambda f: overview.quality_labels(quality.system_health(f.vehicle_mart, f.driver_mart, f.thresholds, AS_OF)),
        sql("""SELECT *, CASE WHEN days_lag > 3 OR leads > 10 THEN 'Critical' WHEN days_lag > 1 OR leads > 0 THEN 'Degraded' ELSE 'Healthy' END AS health,
                      CASE WHEN days_lag = 0 THEN 'Optimal' ELSE 'Behind' END AS lag_label,
                      CASE WHEN leads > 0 THEN 'Risk Detected' ELSE 'Clear' END AS leads_label,
                      CASE WHEN null_keys = 0 THEN 'Clean' ELSE 'Error' END AS nulls_label
               FROM (SELECT CAST(DATE '2024-01-31' - max(date_key) AS INTEGER) AS days_lag, count(*) FILTER (WHERE vehicle_id IS NULL) AS null_keys,
                            max(date_key) AS last_data_date, (SELECT count(*) FROM leads) AS leads FROM vm)""", "vm", "vlast", "dlast", leads=_LEADS),
    ),
}
