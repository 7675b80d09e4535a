"""The test tables in fleet shape.

Every row of ``events`` becomes a row of exactly one fact: clicks, errors and signups are
telemetry samples, views are shift reports, purchases are finance days. All customers are
drivers, all suppliers are vehicles. A vehicle is shared by three neighbouring users and has
an even number, so odd suppliers are vehicles that never report. ``k`` is the number 0..99
inside ``props``; measures derived from it are dyadic fractions, so their averages do not
depend on the order of addition.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadbook.operators import dimensions, marts
from roadbook.session import scratch_path
from roadbook.sources import tables
from roadbook.sources.reference import default_thresholds

AS_OF = dt.date(2024, 1, 31)
ALERT_TIME = dt.datetime(2024, 1, 31, 6, 0, 0)
LATE_CUT = dt.date(2024, 1, 20)

# declared, so that opening a table costs no footer-reading job
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _vehicle_id(number: str) -> str:
    return (
        f"concat(CASE {number} % 3 WHEN 0 THEN 'BUS_' WHEN 1 THEN 'CAR_' ELSE 'TRK_' END, "
        f"CAST({number} AS STRING))"
    )


def _id(prefix: str, number: str) -> str:
    return f"concat('{prefix}', CAST({number} AS STRING))"


class Fleet:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id", "ts", "user_id", "event_type", "value",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
            "CAST(ts AS DATE) AS date_key",
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        return self.events.where("event_type IN ('click', 'error', 'signup')").selectExpr(
            f"{_id('evt_', 'event_id')} AS event_id",
            f"{_vehicle_id('(user_id DIV 3 * 2)')} AS vehicle_id",
            f"{_id('DR_', 'user_id')} AS driver_id",
            "ts AS event_timestamp",
            "6.45D + k * 0.001D AS lat",
            "3.39D + k * 0.001D AS lon",
            "value AS speed_kph",
            "CAST(k AS DOUBLE) AS fuel_percent",
            "60D + k * 0.75D AS engine_temp_c",
            "11D + k / 64D AS battery_v",
            "value > 50 AS speeding",
            "date_key",
        )

    @cached_property
    def shifts(self) -> DataFrame:
        return self.events.where("event_type = 'view'").selectExpr(
            f"{_id('health_', 'event_id')} AS event_id",
            f"{_id('DR_', 'user_id')} AS driver_id",
            "ts AS event_timestamp",
            "6D + k % 5 AS shift_hours",
            "CAST(k % 14 AS DOUBLE) AS continuous_driving_hours",
            "k * 5 / 512D AS fatigue_index",
            "k < 60 AS breaks_taken",
            "IF(k >= 60, array('fatigue_risk'), CAST(array() AS ARRAY<STRING>)) AS alerts",
            "date_key",
        )

    @cached_property
    def finance(self) -> DataFrame:
        return self.events.where("event_type = 'purchase'").selectExpr(
            f"{_id('daily_finance_', 'event_id')} AS event_id",
            f"{_id('DR_', 'user_id')} AS driver_id",
            "date_key",
            "value AS total_revenue",
            "k * 0.5D AS total_cost",
            "value - k * 0.5D AS net_profit",
            "IF(k % 8 = 0, 1, 0) AS fraud_alerts_count",
            "'hold' AS trading_position",
            "value + 200 AS end_of_day_balance",
        )

    @cached_property
    def driver_master(self) -> DataFrame:
        return self.table("customer").selectExpr(
            f"{_id('DR_', 'c_custkey')} AS driver_id",
            "IF(c_mktsegment = 'FURNITURE', 'RETIRED', 'ACTIVE') AS status",
        )

    @cached_property
    def vehicle_master(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            f"{_vehicle_id('s_suppkey')} AS vehicle_id",
            "IF(s_nationkey % 5 = 0, 'MAINTENANCE', 'ACTIVE') AS status",
        )

    @cached_property
    def stored_drivers(self) -> DataFrame:
        """A driver dimension as an earlier run might have left it: active, seen once in 1970."""
        return self.driver_master.where("status = 'ACTIVE'").selectExpr(
            "driver_id", "'RETIRED' AS status",
            "TIMESTAMP_NTZ '1970-01-01' AS first_seen_at", "TIMESTAMP_NTZ '1970-01-01' AS last_seen_at",
        )

    @cached_property
    def stored_vehicles(self) -> DataFrame:
        return self.vehicle_master.where("status = 'ACTIVE'").selectExpr(
            "vehicle_id", "'BUS' AS vehicle_type", "'MAINTENANCE' AS status",
            "TIMESTAMP_NTZ '2023-06-01' AS first_seen_at", "TIMESTAMP_NTZ '2023-06-01' AS last_seen_at",
        )

    @cached_property
    def dim_driver(self) -> DataFrame:
        return dimensions.build_dim_driver(self.stored_drivers, self.driver_master, self.shifts)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return dimensions.build_dim_vehicle(self.stored_vehicles, self.vehicle_master, self.telemetry)

    @cached_property
    def thresholds(self) -> DataFrame:
        return default_thresholds(self.spark)

    @cached_property
    def driver_mart(self) -> DataFrame:
        return marts.driver_daily_metrics(self.telemetry, self.shifts, self.finance, self.driver_master)

    @cached_property
    def vehicle_mart(self) -> DataFrame:
        return marts.vehicle_daily_metrics(self.telemetry, self.thresholds)

    @cached_property
    def span(self) -> tuple[dt.date, dt.date]:
        """First and last day of the events."""
        return tuple(self.events.agg(F.min("date_key"), F.max("date_key")).first())

    @cached_property
    def stored_driver_mart(self) -> DataFrame:
        """The mart written once, for queries that read it more than once."""
        return tables.materialize(self.driver_mart, "driver-mart")

    @cached_property
    def stored_vehicle_mart(self) -> DataFrame:
        return tables.materialize(self.vehicle_mart, "vehicle-mart")

    # late data: the first load misses the error events and everything after LATE_CUT -----------

    def early(self, name: str) -> DataFrame:
        clone = Fleet(self.spark, self.dir)
        clone.__dict__["events"] = self.events.where(
            (F.col("event_type") != "error") & (F.col("date_key") <= F.lit(LATE_CUT))
        )
        return getattr(clone, name)

    def late(self, name: str) -> DataFrame:
        """The rows of a fact that the first load did not bring."""
        clone = Fleet(self.spark, self.dir)
        clone.__dict__["events"] = self.events.where(
            (F.col("event_type") == "error") | (F.col("date_key") > F.lit(LATE_CUT))
        )
        return getattr(clone, name)

    # raw lines -----------------------------------------------------------------------------------

    def lake(self, domain: str) -> str:
        """The raw lines of a domain as text files in a fresh folder of the shared scratch location."""
        path = scratch_path(self.spark, domain)
        lines = {"vehicles": "raw_vehicle_lines", "driver_health": "raw_health_lines", "finance": "raw_finance_lines",
                 "bad_finance": "bad_finance_lines"}
        getattr(self, lines[domain]).write.text(path)
        return path

    @cached_property
    def raw_vehicle_lines(self) -> DataFrame:
        """One JSON object per event; some lack a timestamp, carry nulls or break a range.

        Purchases carry no timestamp key, signups a null driver, views a speed below zero.
        """
        return self.events.selectExpr(
            f"""concat(
                '{{"event_id": "evt_', CAST(event_id AS STRING), '", "vehicle_id": "', {_vehicle_id('user_id')}, '"',
                IF(event_type = 'signup', ', "driver_id": null', concat(', "driver_id": "DR_', CAST(user_id AS STRING), '"')),
                IF(event_type = 'purchase', '',
                   concat(', "timestamp": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z"')),
                ', "lat": ', CAST(k - 5 AS STRING), ', "lon": ', CAST(k * 2 - 10 AS STRING),
                ', "speed_kph": ', CAST(IF(event_type = 'view', -1, k) AS STRING),
                ', "fuel_percent": ', CAST(k + 3 AS STRING),
                IF(event_type = 'click', ', "speeding": true', ''), '}}') AS value"""
        )

    @cached_property
    def raw_health_lines(self) -> DataFrame:
        """One shift report per event; signups carry a fatigue above one, errors no alert list."""
        return self.events.selectExpr(
            f"""to_json(named_struct(
                'event_id', {_id('health_', 'event_id')}, 'driver_id', {_id('DR_', 'user_id')},
                'timestamp', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z'),
                'shift_hours', k % 12 - 1, 'continuous_driving_hours', k % 6,
                'fatigue_index', IF(event_type = 'signup', k / 64D, k / 128D), 'breaks_taken', k < 60,
                'alerts', IF(event_type <> 'error', array('fatigue_risk'), NULL))) AS value"""
        )

    @cached_property
    def bad_finance_lines(self) -> DataFrame:
        """One finance day with two trips per order, most with a fault that depends on the order's status.

        O: good, but the second trip costs less than nothing. F: negative revenue, unreadable date.
        P: the cost is a text, the driver null, the trips no list.
        """
        trip = "named_struct('event_id', concat('t', CAST(i AS STRING)), 'driver_id', 'd', 'timestamp', '2024-01-01T00:00:00Z', 'revenue', 1D, 'total_cost', IF(i = 2, -1D, 1D))"
        trips = f"to_json(transform(sequence(1, 2), i -> {trip}))"
        return self.table("orders").selectExpr(
            f"""concat('{{"event_id": "', CAST(o_orderkey AS STRING), '", "driver_id": ',
                IF(o_orderstatus = 'P', 'null', '"d"'), ', "date": "', IF(o_orderstatus = 'F', 'soon', '2024-01-01'),
                '", "total_revenue": ', IF(o_orderstatus = 'F', '-1', '5'), ', "total_cost": ', IF(o_orderstatus = 'P', '"free"', '2'),
                ', "net_profit": 3, "trips": ', IF(o_orderstatus = 'P', '"none"', {trips}), '}}') AS value"""
        )

    @cached_property
    def raw_finance_lines(self) -> DataFrame:
        """One finance day per order with one to five trips (the digit of the order priority).

        Orders with status P declare ten more than their trips earned; status F leaves the
        fraud count out.
        """
        day = self.table("orders").selectExpr(
            "*", "CAST(substring(o_orderpriority, 1, 1) AS INT) AS n",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
        ).selectExpr(
            "*", "floor(o_totalprice / n) + 0.25D AS share", "n * (n + 1) * 0.875D + n * 0.5D AS cost",
        ).selectExpr("*", "round(share * n + IF(o_orderstatus = 'P', 10, 0), 2) AS revenue")
        driver = _id("DR_", "o_custkey")
        return day.selectExpr(
            f"""to_json(named_struct(
                'event_id', {_id('daily_finance_', 'o_orderkey')}, 'driver_id', {driver}, 'date', day,
                'total_revenue', revenue, 'total_cost', cost, 'net_profit', round(revenue - cost, 2),
                'fraud_alerts_count', IF(o_orderstatus <> 'F', IF(n >= 3, 1, 0), NULL),
                'trading_position', 'hold', 'end_of_day_balance', 200D,
                'trips', transform(sequence(1, n), i -> named_struct(
                    'event_id', concat('trip_', CAST(o_orderkey AS STRING), '_', CAST(i AS STRING)), 'driver_id', {driver},
                    'timestamp', concat(day, 'T0', CAST(i AS STRING), ':00:00Z'), 'revenue', share,
                    'fuel_cost', i * 1.5D, 'toll_fees', i * 0.25D, 'maintenance_cost', 0.5D,
                    'total_cost', i * 1.75D + 0.5D, 'fraud_alert', IF(i = 3, true, NULL))))) AS value"""
        )
