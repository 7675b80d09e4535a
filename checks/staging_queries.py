"""Raw lines to staged records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.binding import Fleet
from checks.oracle import _VEHICLE, sql
from roadbook import schemas
from roadbook.operators import conform, staging
from roadbook.sources import raw


def _vehicles(f: Fleet) -> DataFrame:
    return staging.vehicle_violations(raw.read_raw(f.spark, f.lake("vehicles"), schemas.RAW_VEHICLES))


def _health(f: Fleet) -> DataFrame:
    return staging.health_violations(raw.read_raw(f.spark, f.lake("driver_health"), schemas.RAW_HEALTH))


def _finance(f: Fleet) -> DataFrame:
    return staging.finance_violations(raw.read_raw(f.spark, f.lake("finance"), schemas.RAW_FINANCE))


def missing_keys(f: Fleet) -> DataFrame:
    """Records per missing key."""
    absent = staging.missing_keys("present_keys", staging.VEHICLE_KEYS)
    return _vehicles(f).select(F.explode(absent).alias("key")).groupBy("key").agg(F.count("*").alias("records"))


def vehicle_violations(f: Fleet) -> DataFrame:
    return _vehicles(f).select("event_id", "violations")


def health_violations(f: Fleet) -> DataFrame:
    return _health(f).select("event_id", "violations")


def _bad_finance(f: Fleet) -> DataFrame:
    return staging.finance_violations(raw.read_raw(f.spark, f.lake("bad_finance"), schemas.RAW_FINANCE))


def finance_violations(f: Fleet) -> DataFrame:
    return _bad_finance(f).select("event_id", "violations")


def trip_violations(f: Fleet) -> DataFrame:
    """Trips of the days that pass."""
    good, _ = staging.enforce(_bad_finance(f), "quarantine")
    return staging.trip_violations(staging.explode_trips(good)).select("daily_event_id", "event_id", "violations")


def stage_vehicles(f: Fleet) -> DataFrame:
    good, _ = staging.enforce(_vehicles(f), "quarantine")
    return staging.stage_vehicles(good)


def read_raw(f: Fleet) -> DataFrame:
    """Lines written to the lake as text files, then scanned with file lineage."""
    lines = raw.read_raw(f.spark, f.lake("vehicles"), schemas.RAW_VEHICLES)
    return lines.groupBy("driver_id").agg(
        F.count("*").alias("records"),
        F.count("timestamp").alias("with_time"),
        F.sum("lat").alias("lat_sum"),
        F.count("source_file").alias("with_lineage"),
    )


def to_fact(f: Fleet) -> DataFrame:
    """Good records as telemetry facts."""
    good, _ = staging.enforce(_vehicles(f), "quarantine")
    facts = conform.to_fact(staging.stage_vehicles(good))
    keyed = conform.drop_null_keys(facts, ["event_id", "vehicle_id", "driver_id", "event_timestamp"])
    return conform.align(keyed, schemas.FACT_VEHICLE_TELEMETRY)


def stage_health(f: Fleet) -> DataFrame:
    good, _ = staging.enforce(_health(f), "quarantine")
    return staging.stage_driver_health(good)


def stage_finance_daily(f: Fleet) -> DataFrame:
    """Strict mode: the data is clean, so the job passes."""
    return staging.stage_finance_daily(staging.enforce(_finance(f), "strict"))


def stage_trips(f: Fleet) -> DataFrame:
    trips = staging.trip_violations(staging.explode_trips(_finance(f)))
    return staging.stage_finance_trips(staging.enforce(trips, "strict"))


def quarantine(f: Fleet) -> DataFrame:
    """Records on each side of the split, by domain."""
    def sides(domain: str, df: DataFrame) -> DataFrame:
        side = F.when(F.col("quarantined"), "bad").otherwise("good")
        return df.select(*staging.tagged_columns([])).groupBy(side.alias("side")).agg(F.count("*").alias("records")).withColumn("domain", F.lit(domain))

    return sides("vehicles", _vehicles(f)).unionByName(sides("health", _health(f))).unionByName(
        sides("finance", _finance(f))
    )


def violation_counts(f: Fleet) -> DataFrame:
    codes = _vehicles(f).select(F.explode("violations").alias("code")).unionAll(
        _health(f).select(F.explode("violations").alias("code"))
    )
    return codes.groupBy("code").agg(F.count("*").alias("records"))


# what the raw lines carry, straight from the events
_RAWV = f"""
    SELECT event_id, user_id, event_type, ts, 'evt_' || CAST(event_id AS VARCHAR) AS eid, {_VEHICLE.format(n='user_id')} AS vehicle_id,
           CASE WHEN event_type <> 'signup' THEN 'DR_' || CAST(user_id AS VARCHAR) END AS driver_id,
           CASE WHEN event_type <> 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS stamp,
           CAST(k - 5 AS DOUBLE) AS lat, CAST(k * 2 - 10 AS DOUBLE) AS lon,
           CAST(CASE WHEN event_type = 'view' THEN -1 ELSE k END AS DOUBLE) AS speed_kph, CAST(k + 3 AS DOUBLE) AS fuel_percent
    FROM ev"""
_CODES = """
    SELECT *, list_filter([CASE WHEN stamp IS NULL THEN 'missing_timestamp' END, CASE WHEN lat > 90 THEN 'lat_out_of_range' END,
                           CASE WHEN lon > 180 THEN 'lon_out_of_range' END, CASE WHEN speed_kph < 0 THEN 'speed_negative' END,
                           CASE WHEN fuel_percent > 100 THEN 'fuel_out_of_range' END], lambda x: x IS NOT NULL) AS violations
    FROM rawv"""
_RAWH = """
    SELECT *, k % 12 - 1 AS shift_hours, k % 6 AS continuous, CASE WHEN event_type = 'signup' THEN k / 64e0 ELSE k / 128e0 END AS fatigue
    FROM ev"""
_DAY = """
    SELECT *, 'DR_' || CAST(o_custkey AS VARCHAR) AS driver_id, CAST(left(o_orderpriority, 1) AS INTEGER) AS n,
           floor(o_totalprice / CAST(left(o_orderpriority, 1) AS INTEGER)) + 0.25e0 AS share FROM orders"""
_CLEAN_V = "len(violations) = 0"
_CLEAN_H = "shift_hours >= 0 AND fatigue <= 1"

QUERIES = {
    "missing_keys": (
        missing_keys,
        sql("SELECT 'timestamp' AS key, count(*) AS records FROM rawv WHERE stamp IS NULL", "ev", rawv=_RAWV),
    ),
    "vehicle_violations": (
        vehicle_violations, sql("SELECT eid AS event_id, violations FROM coded", "ev", rawv=_RAWV, coded=_CODES),
    ),
    "health_violations": (
        health_violations,
        sql("""SELECT 'health_' || CAST(event_id AS VARCHAR) AS event_id,
                      list_filter([CASE WHEN shift_hours < 0 THEN 'shift_hours_negative' END,
                                   CASE WHEN fatigue > 1 THEN 'fatigue_out_of_range' END], lambda x: x IS NOT NULL) AS violations
               FROM rawh""", "ev", rawh=_RAWH),
    ),
    "finance_violations": (
        finance_violations,
        """SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
                  CASE o_orderstatus WHEN 'F' THEN ['revenue_negative', 'bad_time']
                                     WHEN 'P' THEN ['bad_type_total_cost', 'bad_type_trips', 'null_driver_id']
                                     ELSE CAST([] AS VARCHAR[]) END AS violations FROM orders""",
    ),
    "trip_violations": (
        trip_violations,
        """SELECT CAST(o_orderkey AS VARCHAR) AS daily_event_id, 't' || CAST(i AS VARCHAR) AS event_id,
                  CASE WHEN i = 2 THEN ['cost_negative'] ELSE CAST([] AS VARCHAR[]) END AS violations
           FROM orders, (SELECT unnest([1, 2]) AS i) t WHERE o_orderstatus NOT IN ('F', 'P')""",
    ),
    "stage_vehicles": (
        stage_vehicles,
        sql(f"""SELECT eid AS event_id, vehicle_id, driver_id, stamp AS timestamp, lat, lon, speed_kph, fuel_percent,
                       CAST(NULL AS DOUBLE) AS engine_temp_c, CAST(NULL AS DOUBLE) AS battery_v, event_type = 'click' AS speeding
                FROM coded WHERE {_CLEAN_V}""", "ev", rawv=_RAWV, coded=_CODES),
    ),
    "to_fact": (
        to_fact,
        sql(f"""SELECT eid AS event_id, vehicle_id, driver_id, date_trunc('second', ts) AS event_timestamp, lat, lon, speed_kph, fuel_percent,
                       CAST(NULL AS DOUBLE) AS engine_temp_c, CAST(NULL AS DOUBLE) AS battery_v, event_type = 'click' AS speeding,
                       CAST(ts AS DATE) AS date_key
                FROM coded WHERE {_CLEAN_V} AND driver_id IS NOT NULL""", "ev", rawv=_RAWV, coded=_CODES),
    ),
    "read_raw": (
        read_raw,
        sql("SELECT driver_id, count(*) AS records, count(stamp) AS with_time, sum(lat) AS lat_sum, count(*) AS with_lineage "
            "FROM rawv GROUP BY driver_id", "ev", rawv=_RAWV),
    ),
    "stage_health": (
        stage_health,
        sql(f"""SELECT 'health_' || CAST(event_id AS VARCHAR) AS event_id, 'DR_' || CAST(user_id AS VARCHAR) AS driver_id,
                       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CAST(shift_hours AS DOUBLE) AS shift_hours,
                       CAST(continuous AS DOUBLE) AS continuous_driving_hours, round(fatigue, 6) AS fatigue_index, k < 60 AS breaks_taken,
                       CASE WHEN event_type = 'error' THEN CAST([] AS VARCHAR[]) ELSE ['fatigue_risk'] END AS alerts
                FROM rawh WHERE {_CLEAN_H}""", "ev", rawh=_RAWH),
    ),
    "stage_finance_daily": (
        stage_finance_daily,
        sql("""SELECT 'daily_finance_' || CAST(o_orderkey AS VARCHAR) AS event_id, driver_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
                      round(share * n + CASE WHEN o_orderstatus = 'P' THEN 10 ELSE 0 END, 2) AS total_revenue,
                      n * (n + 1) * 0.875e0 + n * 0.5e0 AS total_cost,
                      round(round(share * n + CASE WHEN o_orderstatus = 'P' THEN 10 ELSE 0 END, 2) - (n * (n + 1) * 0.875e0 + n * 0.5e0), 2) AS net_profit,
                      CASE WHEN o_orderstatus <> 'F' AND n >= 3 THEN 1 ELSE 0 END AS fraud_alerts_count, 'hold' AS trading_position,
                      200e0 AS end_of_day_balance
               FROM day""", day=_DAY),
    ),
    "stage_trips": (
        stage_trips,
        sql("""SELECT 'trip_' || CAST(o_orderkey AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS trip_event_id,
                      'daily_finance_' || CAST(o_orderkey AS VARCHAR) AS daily_event_id, driver_id,
                      strftime(o_orderdate, '%Y-%m-%d') || 'T0' || CAST(i AS VARCHAR) || ':00:00Z' AS timestamp, share AS revenue,
                      i * 1.5e0 AS fuel_cost, i * 0.25e0 AS toll_fees, 0.5e0 AS maintenance_cost, i * 1.75e0 + 0.5e0 AS total_cost,
                      i = 3 AS fraud_alert
               FROM day, LATERAL (SELECT unnest(generate_series(1, day.n)) AS i) g""", day=_DAY),
    ),
    "quarantine": (
        quarantine,
        sql(f"""SELECT 'vehicles' AS domain, CASE WHEN {_CLEAN_V} THEN 'good' ELSE 'bad' END AS side, count(*) AS records FROM coded GROUP BY ALL
                UNION ALL SELECT 'health', CASE WHEN {_CLEAN_H} THEN 'good' ELSE 'bad' END, count(*) FROM rawh GROUP BY ALL
                UNION ALL SELECT 'finance', 'good', count(*) FROM orders""", "ev", rawv=_RAWV, coded=_CODES, rawh=_RAWH),
    ),
    "violation_counts": (
        violation_counts,
        sql("""SELECT code, count(*) AS records FROM (
                 SELECT unnest(violations) AS code FROM coded
                 UNION ALL SELECT 'shift_hours_negative' FROM rawh WHERE shift_hours < 0
                 UNION ALL SELECT 'fatigue_out_of_range' FROM rawh WHERE fatigue > 1) GROUP BY code""",
            "ev", rawv=_RAWV, coded=_CODES, rawh=_RAWH),
    ),
}
