"""Daily marts: one row per driver-day and one per vehicle-day.

The driver mart reads three facts. Instead of three aggregates joined on a distinct key set,
the facts are stacked and aggregated once: the groups *are* the union of the keys, partial
aggregation shrinks hot driver-days before the only shuffle, and no fan-out can occur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadbook import schemas
from roadbook.functions.expressions import high_water, rate, threshold
from roadbook.operators.conform import align
from roadbook.operators.upserts import delete_keys

DRIVER_DAY = ["driver_id", "date_key"]
VEHICLE_DAY = ["vehicle_id", "date_key"]

# Limits of the driver flags.
SPEEDING_RATE_LIMIT = 0.10
FATIGUE_LIMIT = 0.7
CONTINUOUS_HOURS_LIMIT = 8

# Names under which the vehicle flags look up their limits.
TEMP_METRIC = "engine_temp_c"
BATTERY_METRIC = "battery_voltage"
SPEEDING_METRIC = "speeding_rate"


# key sets ----------------------------------------------------------------------------------

def after_mark(fact: DataFrame, mark: Column | None) -> DataFrame:
    """Rows of days strictly after the mark; prunes partitions of a date-partitioned fact."""
    return fact if mark is None else fact.where(F.col("date_key") > mark)


def changed_driver_days(*facts: DataFrame, mark: Column | None = None) -> DataFrame:
    """Driver-days that occur in any of the facts."""
    keys = [after_mark(f, mark).select(*DRIVER_DAY) for f in facts]
    return reduce(DataFrame.union, keys).distinct()


def changed_vehicle_days(tel: DataFrame, mark: Column | None = None) -> DataFrame:
    return after_mark(tel, mark).select(*VEHICLE_DAY).distinct()


def restrict(fact: DataFrame, keyset: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a fact whose key is listed."""
    return fact.join(keyset.select(*keys), keys, "left_semi")


# measures ----------------------------------------------------------------------------------

# NULL-safe by construction: count and count_if skip nulls, sums of nothing stay null
_TELEMETRY_MEASURES = [
    "count(event_id) AS total_events",
    "avg(speed_kph) AS avg_speed_kph",
    "count_if(speeding) AS speeding_events",
]
_SHIFT_MEASURES = [
    "sum(shift_hours) AS total_shift_hours",
    "max(continuous_driving_hours) AS max_continuous_hours",
    "avg(fatigue_index) AS avg_fatigue_index",
    "sum(array_size(alerts)) AS alerts_count",
]
_FINANCE_MEASURES = [
    "sum(total_revenue) AS total_revenue",
    "sum(total_cost) AS total_cost",
    "sum(net_profit) AS net_profit",
    "sum(fraud_alerts_count) AS fraud_alerts_count",
]
VEHICLE_MEASURES = [
    "count(event_id) AS telemetry_events",
    "avg(speed_kph) AS avg_speed_kph",
    "max(speed_kph) AS max_speed_kph",
    "avg(fuel_percent) AS avg_fuel_percent",
    "avg(engine_temp_c) AS avg_engine_temp_c",
    "avg(battery_v) AS avg_battery_voltage",
    "count_if(speeding) AS speeding_events",
]


def _per_key(rows: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.expr(m) for m in measures])


def telemetry_agg(tel: DataFrame) -> DataFrame:
    return _per_key(tel, DRIVER_DAY, *_TELEMETRY_MEASURES)


def shift_agg(shifts: DataFrame) -> DataFrame:
    return _per_key(shifts, DRIVER_DAY, *_SHIFT_MEASURES)


def finance_agg(fin: DataFrame) -> DataFrame:
    return _per_key(fin, DRIVER_DAY, *_FINANCE_MEASURES)


def driver_day_measures(tel: DataFrame, shifts: DataFrame, fin: DataFrame) -> DataFrame:
    """All driver-day measures in one aggregation; a measure without source rows is null or 0."""
    stacked = (
        tel.select(*DRIVER_DAY, "event_id", "speed_kph", "speeding")
        .unionByName(
            shifts.select(*DRIVER_DAY, "shift_hours", "continuous_driving_hours", "fatigue_index", "alerts"),
            allowMissingColumns=True,
        )
        .unionByName(
            fin.select(*DRIVER_DAY, "total_revenue", "total_cost", "net_profit", "fraud_alerts_count"),
            allowMissingColumns=True,
        )
    )
    return _per_key(
        stacked, DRIVER_DAY, *_TELEMETRY_MEASURES, *_SHIFT_MEASURES, *_FINANCE_MEASURES
    )


# driver mart -------------------------------------------------------------------------------

def driver_flags(df: DataFrame) -> DataFrame:
    """Speeding (null without telemetry), fatigue (never for retired drivers) and fraud flags."""
    tired = (F.col("avg_fatigue_index") > FATIGUE_LIMIT) | (
        F.col("max_continuous_hours") > CONTINUOUS_HOURS_LIMIT
    )
    return df.withColumns(
        {
            "speeding_alert": rate("speeding_events", "total_events") > SPEEDING_RATE_LIMIT,
            "fatigue_alert": F.when(F.col("status") == "RETIRED", F.lit(False)).otherwise(tired),
            "fraud_alert": F.col("fraud_alerts_count") > 0,
        }
    )


def driver_daily_metrics(
    tel: DataFrame, shifts: DataFrame, fin: DataFrame, dim: DataFrame,
    mark: Column | None = None, keyset: DataFrame | None = None,
) -> DataFrame:
    """Driver mart rows, for days after ``mark`` and driver-days in ``keyset`` where given.

    Drivers that the dimension does not list are left out (see ``quality.orphans``).
    """
    days = driver_day_measures(*(after_mark(f, mark) for f in (tel, shifts, fin)))
    if keyset is not None:
        # pushed below the aggregate by the planner when the key set is small enough to broadcast
        days = restrict(days, keyset, DRIVER_DAY)
    filled = days.selectExpr(
        *[c if c in DRIVER_DAY else f"coalesce({c}, 0) AS {c}" for c in days.columns]
    )
    known = filled.join(dim.select("driver_id", "status"), "driver_id")
    return align(driver_flags(known), schemas.FACT_DRIVER_DAILY_METRICS)


# vehicle mart ------------------------------------------------------------------------------

def threshold_row(thresholds: DataFrame) -> DataFrame:
    """Warning limits of the vehicle flags as one row."""
    def warn(metric: str) -> Column:
        return F.max(F.when(F.col("metric_name") == metric, F.col("warning_threshold")))

    return thresholds.agg(
        warn(TEMP_METRIC).alias("temp_warn"),
        warn(BATTERY_METRIC).alias("batt_warn"),
        warn(SPEEDING_METRIC).alias("speed_warn"),
    )


def vehicle_day_measures(tel: DataFrame) -> DataFrame:
    return _per_key(tel, VEHICLE_DAY, *VEHICLE_MEASURES)


def vehicle_flags(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Flags against the configured warning limits; the rate is compared unrounded."""
    return df.withColumns(
        {
            "speeding_alert": rate("speeding_events", "telemetry_events")
            > threshold(thresholds, SPEEDING_METRIC),
            "engine_temp_alert": F.col("avg_engine_temp_c") > threshold(thresholds, TEMP_METRIC),
            "battery_alert": F.col("avg_battery_voltage") < threshold(thresholds, BATTERY_METRIC),
        }
    )


def vehicle_daily_metrics(
    tel: DataFrame, thresholds: DataFrame,
    mark: Column | None = None, keyset: DataFrame | None = None,
) -> DataFrame:
    """Vehicle mart rows, for days after ``mark`` and vehicle-days in ``keyset`` where given.

    The key set filters after the aggregation; the planner moves it below when it is small
    enough to broadcast, so a large key set never makes the raw fact shuffle a second time.
    """
    days = vehicle_day_measures(after_mark(tel, mark))
    if keyset is not None:
        days = restrict(days, keyset, VEHICLE_DAY)
    rated = days.withColumn(
        "speeding_rate", F.round(rate("speeding_events", "telemetry_events"), 3)
    )
    return align(vehicle_flags(rated, thresholds), schemas.FACT_VEHICLE_DAILY_METRICS)


# incremental refresh -----------------------------------------------------------------------

def refresh(mart: DataFrame, recomputed: DataFrame, keys: list[str], keyset: DataFrame | None = None) -> DataFrame:
    """Next state of a mart: listed keys leave, recomputed rows enter."""
    keyset = recomputed if keyset is None else keyset
    return delete_keys(mart, keyset, keys).unionByName(recomputed)


def refresh_driver(
    mart: DataFrame, tel: DataFrame, shifts: DataFrame, fin: DataFrame, dim: DataFrame,
    policy: str = "high_watermark", touched: DataFrame | None = None,
) -> DataFrame:
    """Refresh the driver mart.

    ``high_watermark`` adds the days after the newest stored one and never revisits a day.
    ``touched_keys`` recomputes every driver-day in ``touched`` (the keys of newly stored
    facts), however old.
    """
    if policy == "high_watermark":
        # stored days are all at or before the mark, so nothing has to be deleted
        return mart.unionByName(driver_daily_metrics(tel, shifts, fin, dim, mark=high_water(mart)))
    if policy == "touched_keys":
        fresh = driver_daily_metrics(tel, shifts, fin, dim, keyset=_required(touched))
        return refresh(mart, fresh, DRIVER_DAY, touched)
    raise ValueError(f"unknown policy {policy!r}")


def refresh_vehicle(
    mart: DataFrame, tel: DataFrame, thresholds: DataFrame,
    policy: str = "high_watermark", touched: DataFrame | None = None,
) -> DataFrame:
    """Refresh the vehicle mart; policies as in :func:`refresh_driver`."""
    if policy == "high_watermark":
        return mart.unionByName(vehicle_daily_metrics(tel, thresholds, mark=high_water(mart)))
    if policy == "touched_keys":
        fresh = vehicle_daily_metrics(tel, thresholds, keyset=_required(touched))
        return refresh(mart, fresh, VEHICLE_DAY, touched)
    raise ValueError(f"unknown policy {policy!r}")


def _required(touched: DataFrame | None) -> DataFrame:
    if touched is None:
        raise ValueError("touched_keys needs the touched key set")
    return touched


# trips -------------------------------------------------------------------------------------

def rollup_trips(trips: DataFrame) -> DataFrame:
    """Day totals of the staged trips."""
    day = F.to_date("timestamp").alias("date_key")
    totals = trips.groupBy("driver_id", day).agg(
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.sum("total_cost"), 2).alias("total_cost"),
        F.count_if(F.col("fraud_alert")).alias("fraud_alerts_count"),
    )
    profit = F.round(F.col("total_revenue") - F.col("total_cost"), 2)
    return totals.select(
        *DRIVER_DAY, "total_revenue", "total_cost", profit.alias("net_profit"), "fraud_alerts_count"
    )


def reconcile_finance(daily: DataFrame, trips: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Driver-days whose declared totals differ from their trips, or that one side lacks."""
    declared = daily.groupBy(*DRIVER_DAY).agg(
        F.round(F.sum("total_revenue"), 2).alias("declared_revenue"),
        F.round(F.sum("total_cost"), 2).alias("declared_cost"),
        F.sum("fraud_alerts_count").alias("declared_fraud"),
    )
    counted = rollup_trips(trips).select(
        *DRIVER_DAY,
        F.col("total_revenue").alias("trip_revenue"),
        F.col("total_cost").alias("trip_cost"),
        F.col("fraud_alerts_count").alias("trip_fraud"),
    )

    def differs(left: str, right: str, by: float) -> Column:
        gap = F.abs(F.col(left) - F.col(right))
        return F.coalesce(gap > by, F.lit(True))

    return declared.join(counted, DRIVER_DAY, "full_outer").where(
        differs("declared_revenue", "trip_revenue", tolerance)
        | differs("declared_cost", "trip_cost", tolerance)
        | differs("declared_fraud", "trip_fraud", 0)
    )
