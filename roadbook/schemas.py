"""Table contracts. Every read uses one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "strings": T.ArrayType(T.StringType()),
}


def _table(**columns: str | T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES.get(kind, kind)) for name, kind in columns.items()]
    )


# raw drops: one JSON object per line -------------------------------------------------------

RAW_VEHICLES = _table(
    event_id="string", vehicle_id="string", driver_id="string", timestamp="string",
    lat="double", lon="double", speed_kph="double", heading="double",
    engine_temp_c="double", battery_v="double", fuel_percent="double",
    speed_zone_kph="int", speeding="boolean", obd_codes="strings",
)

RAW_HEALTH = _table(
    event_id="string", driver_id="string", timestamp="string", shift_hours="double",
    continuous_driving_hours="double", fatigue_index="double", breaks_taken="boolean",
    alerts="strings",
)

# trips stay JSON text here, one string per trip: each is parsed and checked as a record of its own
RAW_FINANCE = _table(
    event_id="string", driver_id="string", date="string", total_revenue="double",
    total_cost="double", net_profit="double", fraud_alerts_count="double",
    trading_position="string", end_of_day_balance="double", trips="strings",
)

RAW_TRIP = _table(
    event_id="string", driver_id="string", timestamp="string", revenue="double",
    fuel_cost="double", toll_fees="double", maintenance_cost="double",
    total_cost="double", fraud_alert="boolean",
)

MASTER_DRIVERS = _table(driver_id="string", status="string")
MASTER_VEHICLES = _table(vehicle_id="string", status="string")

# staged tables -----------------------------------------------------------------------------

STAGED_VEHICLES = _table(
    event_id="string", vehicle_id="string", driver_id="string", timestamp="string",
    lat="double", lon="double", speed_kph="double", fuel_percent="double",
    engine_temp_c="double", battery_v="double", speeding="boolean",
)

STAGED_HEALTH = RAW_HEALTH

# the raw count is read as a number, as some writers put 2.0
STAGED_FINANCE = T.StructType([
    T.StructField(f.name, T.IntegerType()) if f.name == "fraud_alerts_count" else f for f in RAW_FINANCE if f.name != "trips"
])

STAGED_TRIPS = _table(
    trip_event_id="string", daily_event_id="string", driver_id="string", timestamp="string",
    revenue="double", fuel_cost="double", toll_fees="double", maintenance_cost="double",
    total_cost="double", fraud_alert="boolean",
)

# star schema -------------------------------------------------------------------------------

DIM_DATE = _table(
    date_key="date", year="int", month="int", day="int", week_of_year="int",
    day_of_week="string", is_weekend="boolean",
)

DIM_DRIVER = _table(
    driver_id="string", status="string", first_seen_at="timestamp_ntz",
    last_seen_at="timestamp_ntz",
)

DIM_VEHICLE = _table(
    vehicle_id="string", vehicle_type="string", status="string",
    first_seen_at="timestamp_ntz", last_seen_at="timestamp_ntz",
)

FACT_VEHICLE_TELEMETRY = _table(
    event_id="string", vehicle_id="string", driver_id="string",
    event_timestamp="timestamp_ntz", lat="double", lon="double", speed_kph="double",
    fuel_percent="double", engine_temp_c="double", battery_v="double", speeding="boolean",
    date_key="date",
)

FACT_DRIVER_SHIFTS = _table(
    event_id="string", driver_id="string", event_timestamp="timestamp_ntz",
    shift_hours="double", continuous_driving_hours="double", fatigue_index="double",
    breaks_taken="boolean", alerts="strings", date_key="date",
)

FACT_DAILY_FINANCE = _table(
    event_id="string", driver_id="string", date_key="date", total_revenue="double",
    total_cost="double", net_profit="double", fraud_alerts_count="int",
    trading_position="string", end_of_day_balance="double",
)

# Counters are BIGINT: one hot driver-day may hold more events than an INTEGER can count.
FACT_DRIVER_DAILY_METRICS = _table(
    driver_id="string", date_key="date", total_events="bigint", avg_speed_kph="double",
    speeding_events="bigint", total_shift_hours="double", max_continuous_hours="double",
    avg_fatigue_index="double", alerts_count="bigint", total_revenue="double",
    total_cost="double", net_profit="double", fraud_alerts_count="bigint",
    speeding_alert="boolean", fatigue_alert="boolean", fraud_alert="boolean",
)

FACT_VEHICLE_DAILY_METRICS = _table(
    vehicle_id="string", date_key="date", telemetry_events="bigint", avg_speed_kph="double",
    max_speed_kph="double", avg_fuel_percent="double", avg_engine_temp_c="double",
    avg_battery_voltage="double", speeding_events="bigint", speeding_rate="double",
    speeding_alert="boolean", engine_temp_alert="boolean", battery_alert="boolean",
)

# daily figures kept by a stream: the measures of the vehicle mart, without rates and flags
LIVE_VEHICLE_DAILY = T.StructType([
    f for f in FACT_VEHICLE_DAILY_METRICS if f.name != "speeding_rate" and not f.name.endswith("_alert")
])

ALERT_THRESHOLDS = _table(
    metric_name="string", warning_threshold="double", critical_threshold="double",
    comparison_op="string", description="string", is_active="boolean",
)

ALERTS = _table(
    alert_name="string", entity_id="string", entity_type="string", metric_name="string",
    metric_value="double", severity="string", alert_time="timestamp_ntz",
    description="string",
)

TABLES = {
    "dim_date": DIM_DATE,
    "dim_driver": DIM_DRIVER,
    "dim_vehicle": DIM_VEHICLE,
    "fact_vehicle_telemetry": FACT_VEHICLE_TELEMETRY,
    "fact_driver_shifts": FACT_DRIVER_SHIFTS,
    "fact_daily_finance": FACT_DAILY_FINANCE,
    "finance_trips": STAGED_TRIPS,
    "fact_driver_daily_metrics": FACT_DRIVER_DAILY_METRICS,
    "fact_vehicle_daily_metrics": FACT_VEHICLE_DAILY_METRICS,
    "live_vehicle_daily": LIVE_VEHICLE_DAILY,
    "alert_thresholds": ALERT_THRESHOLDS,
    "alerts": ALERTS,
}
