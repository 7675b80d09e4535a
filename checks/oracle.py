"""The same fleet shape as DuckDB CTEs, written from the query semantics, not from our plans."""

from __future__ import annotations

_VEHICLE = "(CASE {n} % 3 WHEN 0 THEN 'BUS_' WHEN 1 THEN 'CAR_' ELSE 'TRK_' END || CAST({n} AS VARCHAR))"

CTES: dict[str, str] = {
    "ev": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS date_key
        FROM events""",
    "tel": f"""
        SELECT 'evt_' || CAST(event_id AS VARCHAR) AS event_id,
               {_VEHICLE.format(n='((user_id // 3) * 2)')} AS vehicle_id,
               'DR_' || CAST(user_id AS VARCHAR) AS driver_id, ts AS event_timestamp,
               6.45e0 + k * 0.001e0 AS lat, 3.39e0 + k * 0.001e0 AS lon, value AS speed_kph,
               CAST(k AS DOUBLE) AS fuel_percent, 60e0 + k * 0.75e0 AS engine_temp_c,
               11e0 + k / 64e0 AS battery_v, value > 50 AS speeding, date_key
        FROM ev WHERE event_type IN ('click', 'error', 'signup')""",
    "shf": """
        SELECT 'health_' || CAST(event_id AS VARCHAR) AS event_id,
               'DR_' || CAST(user_id AS VARCHAR) AS driver_id, ts AS event_timestamp,
               6e0 + k % 5 AS shift_hours, CAST(k % 14 AS DOUBLE) AS continuous_driving_hours,
               k * 5 / 512e0 AS fatigue_index, k < 60 AS breaks_taken,
               CASE WHEN k >= 60 THEN '["fatigue_risk"]' ELSE '[]' END AS alerts_json, date_key
        FROM ev WHERE event_type = 'view'""",
    "fin": """
        SELECT 'daily_finance_' || CAST(event_id AS VARCHAR) AS event_id,
               'DR_' || CAST(user_id AS VARCHAR) AS driver_id, date_key,
               value AS total_revenue, k * 0.5e0 AS total_cost, value - k * 0.5e0 AS net_profit,
               CASE WHEN k % 8 = 0 THEN 1 ELSE 0 END AS fraud_alerts_count
        FROM ev WHERE event_type = 'purchase'""",
    "drv": """
        SELECT 'DR_' || CAST(c_custkey AS VARCHAR) AS driver_id,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN 'RETIRED' ELSE 'ACTIVE' END AS status
        FROM customer""",
    "veh": f"""
        SELECT {_VEHICLE.format(n='s_suppkey')} AS vehicle_id,
               CASE WHEN s_nationkey % 5 = 0 THEN 'MAINTENANCE' ELSE 'ACTIVE' END AS status
        FROM supplier""",
    "thr": """
        SELECT * FROM (VALUES
            ('avg_fatigue_index', 0.6e0, 0.8e0, '>', 'Driver fatigue risk', TRUE),
            ('speeding_rate', 0.08e0, 0.12e0, '>', 'High speeding frequency', TRUE),
            ('engine_temp_c', 90e0, 120e0, '>', 'Engine overheating risk', TRUE),
            ('battery_voltage', 11.8e0, 11.2e0, '<', 'Low vehicle battery', TRUE),
            ('fraud_alerts_count', 1e0, 3e0, '>', 'Potential fraud detected', TRUE)
        ) AS v(metric_name, warning_threshold, critical_threshold, comparison_op, description, is_active)""",
    "ta": """
        SELECT driver_id, date_key, count(event_id) AS total_events, avg(speed_kph) AS avg_speed_kph,
               CAST(sum(CASE WHEN speeding THEN 1 ELSE 0 END) AS BIGINT) AS speeding_events
        FROM tel GROUP BY ALL""",
    "sa": """
        SELECT driver_id, date_key, sum(shift_hours) AS total_shift_hours,
               max(continuous_driving_hours) AS max_continuous_hours, avg(fatigue_index) AS avg_fatigue_index,
               CAST(sum(json_array_length(alerts_json)) AS BIGINT) AS alerts_count
        FROM shf GROUP BY ALL""",
    "fa": """
        SELECT driver_id, date_key, sum(total_revenue) AS total_revenue, sum(total_cost) AS total_cost,
               sum(net_profit) AS net_profit, CAST(sum(fraud_alerts_count) AS BIGINT) AS fraud_alerts_count
        FROM fin GROUP BY ALL""",
    "dm": """
        SELECT driver_id, date_key, coalesce(total_events, 0) AS total_events,
               coalesce(avg_speed_kph, 0) AS avg_speed_kph, coalesce(speeding_events, 0) AS speeding_events,
               coalesce(total_shift_hours, 0) AS total_shift_hours,
               coalesce(max_continuous_hours, 0) AS max_continuous_hours,
               coalesce(avg_fatigue_index, 0) AS avg_fatigue_index, coalesce(alerts_count, 0) AS alerts_count,
               coalesce(total_revenue, 0) AS total_revenue, coalesce(total_cost, 0) AS total_cost,
               coalesce(net_profit, 0) AS net_profit, coalesce(fraud_alerts_count, 0) AS fraud_alerts_count,
               speeding_events / CAST(nullif(total_events, 0) AS DOUBLE) > 0.10e0 AS speeding_alert,
               CASE WHEN status = 'RETIRED' THEN FALSE
                    ELSE coalesce(avg_fatigue_index, 0) > 0.7e0 OR coalesce(max_continuous_hours, 0) > 8 END AS fatigue_alert,
               coalesce(fraud_alerts_count, 0) > 0 AS fraud_alert
        FROM ta FULL JOIN sa USING (driver_id, date_key) FULL JOIN fa USING (driver_id, date_key)
        JOIN drv USING (driver_id)""",
    "vm": """
        SELECT *, speeding_events / CAST(telemetry_events AS DOUBLE)
                      > (SELECT warning_threshold FROM thr WHERE metric_name = 'speeding_rate') AS speeding_alert,
               avg_engine_temp_c > (SELECT warning_threshold FROM thr WHERE metric_name = 'engine_temp_c') AS engine_temp_alert,
               avg_battery_voltage < (SELECT warning_threshold FROM thr WHERE metric_name = 'battery_voltage') AS battery_alert
        FROM (SELECT vehicle_id, date_key, count(event_id) AS telemetry_events, avg(speed_kph) AS avg_speed_kph,
                     max(speed_kph) AS max_speed_kph, avg(fuel_percent) AS avg_fuel_percent,
                     avg(engine_temp_c) AS avg_engine_temp_c, avg(battery_v) AS avg_battery_voltage,
                     CAST(count(*) FILTER (WHERE speeding) AS BIGINT) AS speeding_events,
                     round(count(*) FILTER (WHERE speeding) / CAST(count(event_id) AS DOUBLE), 3) AS speeding_rate
              FROM tel GROUP BY ALL)""",
    "ddim": """
        SELECT drv.driver_id, status, min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at
        FROM drv LEFT JOIN shf ON shf.driver_id = drv.driver_id GROUP BY ALL""",
    "vdim": """
        SELECT veh.vehicle_id, CASE WHEN veh.vehicle_id LIKE 'BUS%' THEN 'BUS'
                                    WHEN veh.vehicle_id LIKE 'CAR%' THEN 'CAR' ELSE 'UNKNOWN' END AS vehicle_type,
               status, min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at
        FROM veh LEFT JOIN tel ON tel.vehicle_id = veh.vehicle_id GROUP BY ALL""",
    "dlast": "SELECT * FROM dm WHERE date_key = (SELECT max(date_key) FROM dm)",
    "vlast": "SELECT * FROM vm WHERE date_key = (SELECT max(date_key) FROM vm)",
}

# what each CTE reads, so that a query carries only what it needs
_NEEDS = {
    "ev": [], "tel": ["ev"], "shf": ["ev"], "fin": ["ev"], "drv": [], "veh": [], "thr": [],
    "ta": ["tel"], "sa": ["shf"], "fa": ["fin"], "dm": ["ta", "sa", "fa", "drv"], "vm": ["tel", "thr"],
    "ddim": ["drv", "shf"], "vdim": ["veh", "tel"], "dlast": ["dm"], "vlast": ["vm"],
}


def sql(query: str, *needs: str, **extra: str) -> str:
    """``query`` behind the CTEs it needs; ``extra`` CTEs come last, in the given order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for below in _NEEDS[name]:
                add(below)

    for name in needs:
        add(name)
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + query


DRIVER_MART = [
    "driver_id", "date_key", "total_events", "avg_speed_kph", "speeding_events", "total_shift_hours",
    "max_continuous_hours", "avg_fatigue_index", "alerts_count", "total_revenue", "total_cost",
    "net_profit", "fraud_alerts_count", "speeding_alert", "fatigue_alert", "fraud_alert",
]
VEHICLE_MART = [
    "vehicle_id", "date_key", "telemetry_events", "avg_speed_kph", "max_speed_kph", "avg_fuel_percent",
    "avg_engine_temp_c", "avg_battery_voltage", "speeding_events", "speeding_rate", "speeding_alert",
    "engine_temp_alert", "battery_alert",
]
_SUMMED = {
    "avg_speed_kph", "total_shift_hours", "avg_fatigue_index", "total_revenue", "total_cost", "net_profit",
    "avg_fuel_percent", "avg_engine_temp_c", "avg_battery_voltage",
}


def rounded(columns: list[str]) -> str:
    """Select list with sums and averages rounded as the query side rounds them."""
    return ", ".join(f"round({c}, 6) AS {c}" if c in _SUMMED else c for c in columns)
