"""Alert rules over the marts, the digest, and per-sample driving signals."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadbook import schemas
from roadbook.functions.expressions import latest, latest_day, threshold, threshold_text
from roadbook.functions.text import severity_rank
from roadbook.operators.conform import align

ALERT_COLUMNS = ["entity_id", "entity_type", "metric_name", "metric_value", "severity", "description"]


def _alert(
    df: DataFrame, entity: Column, kind: str, metric: str, value: Column,
    severity: Column, description: Column,
) -> DataFrame:
    return df.select(
        entity.alias("entity_id"),
        F.lit(kind).alias("entity_type"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        severity.alias("severity"),
        description.alias("description"),
    )


def _graded(is_critical: Column) -> Column:
    return F.when(is_critical, F.lit("CRITICAL")).otherwise(F.lit("WARNING"))


def alert_fatigue(
    driver_mart: DataFrame, dim: DataFrame, thresholds: DataFrame, day: dt.date | None = None,
) -> DataFrame:
    """Tired active drivers on the newest day; graded before the shown value is rounded."""
    metric = "avg_fatigue_index"
    active = dim.where(F.col("status") == "ACTIVE").select("driver_id")
    tired = (
        latest(driver_mart, day=day)
        .where(F.col(metric) >= threshold(thresholds, metric))
        .join(active, "driver_id")
    )
    return _alert(
        tired, F.col("driver_id"), "driver", metric, F.round(metric, 1),
        _graded(F.col(metric) >= threshold(thresholds, metric, "critical")),
        threshold_text(thresholds, metric),
    )


def alert_vehicle_risk(vehicle_mart: DataFrame, thresholds: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Hot engines on the newest day, against the configured limits."""
    temp = F.col("avg_engine_temp_c")
    hot = latest(vehicle_mart, day=day).where(temp >= threshold(thresholds, "engine_temp_c"))
    return _alert(
        hot, F.col("vehicle_id"), "vehicle", "engine_temp", temp,
        _graded(temp >= threshold(thresholds, "engine_temp_c", "critical")),
        threshold_text(thresholds, "engine_temp_c"),
    )


def alert_fraud(driver_mart: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Any fraud signal on the newest day."""
    return _alert(
        latest(driver_mart, day=day).where(F.col("fraud_alerts_count") > 0),
        F.col("driver_id"), "driver", "fraud_alerts", F.col("fraud_alerts_count"),
        F.lit("CRITICAL"), F.lit("Fraud signals detected"),
    )


def alert_freshness(
    driver_mart: DataFrame, dim: DataFrame, max_lag: int = 1, day: dt.date | None = None,
) -> DataFrame:
    """Active drivers lag behind the newest day of the whole mart."""
    active = dim.where(F.col("status") == "ACTIVE").select("driver_id")
    newest_active = driver_mart.join(active, "driver_id", "left_semi").agg(
        F.max("date_key").alias("newest")
    )
    newest = latest_day(driver_mart) if day is None else F.lit(day)
    lag = newest_active.select(F.datediff(newest, "newest").alias("lag"))
    return _alert(
        lag.where(F.col("lag") > max_lag),
        F.lit("SYSTEM"), "system", "data_freshness_days_lag", F.col("lag"),
        F.lit("WARNING"), F.lit("Data freshness SLA breach for active fleet"),
    )


def alert_vehicle_static(
    vehicle_mart: DataFrame, temp_limit: float = 95, rate_limit: float = 0.10, critical: float = 100,
) -> DataFrame:
    """Engine temperature or speeding over fixed limits on the newest day."""
    temp = F.col("avg_engine_temp_c")
    risky = latest(vehicle_mart).where((temp > temp_limit) | (F.col("speeding_rate") > rate_limit))
    return _alert(
        risky, F.col("vehicle_id"), "vehicle", "vehicle_risk", temp,
        _graded(temp > critical), F.lit("Engine temp or speeding anomaly"),
    )


def alert_no_activity(driver_mart: DataFrame) -> DataFrame:
    """One row when the newest day has no driver at all, which means an empty mart."""
    drivers = latest(driver_mart).agg(F.count_distinct("driver_id").alias("drivers"))
    return _alert(
        drivers.where(F.col("drivers") == 0),
        F.lit("SYSTEM"), "system", "no_driver_activity", F.lit(0),
        F.lit("CRITICAL"), F.lit("No active drivers today"),
    )


# table-driven rule -------------------------------------------------------------------------

# Threshold name -> mart column.
DRIVER_METRICS = {
    "avg_fatigue_index": "avg_fatigue_index",
    "fraud_alerts_count": "fraud_alerts_count",
}
VEHICLE_METRICS = {
    "speeding_rate": "speeding_rate",
    "engine_temp_c": "avg_engine_temp_c",
    "battery_voltage": "avg_battery_voltage",
}


def metrics_long(mart: DataFrame, entity: str, kind: str, metrics: dict[str, str]) -> DataFrame:
    """One row per entity, day and metric."""
    wide = mart.select(
        F.col(entity).alias("entity_id"),
        "date_key",
        *[F.col(column).cast("double").alias(name) for name, column in metrics.items()],
    )
    long = wide.unpivot(["entity_id", "date_key"], list(metrics), "metric_name", "metric_value")
    return long.withColumn("entity_type", F.lit(kind))


def evaluate_thresholds(
    long: DataFrame, thresholds: DataFrame, inclusive: bool = False, keep: list[str] | None = None,
) -> DataFrame:
    """Every active rule against every metric row, honouring the direction of the rule.

    ``inclusive`` lets a value exactly on the limit count, as the alert queries do.
    """
    rules = thresholds.where("is_active").select(
        "metric_name", "warning_threshold", "critical_threshold", "comparison_op", "description"
    )

    def broken(limit: str) -> Column:
        value, bound = F.col("metric_value"), F.col(limit)
        over = F.when(F.col("comparison_op") == "<", value < bound).when(
            F.col("comparison_op") == ">", value > bound
        )
        return over | (value == bound) if inclusive else over

    severity = F.when(broken("critical_threshold"), F.lit("CRITICAL")).when(
        broken("warning_threshold"), F.lit("WARNING")
    )
    return (
        long.join(rules, "metric_name")
        .withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .select(*ALERT_COLUMNS, *(keep or ["date_key"]))
    )


# one frame, digest, timeline ---------------------------------------------------------------

def all_alerts(
    driver_mart: DataFrame, vehicle_mart: DataFrame, dim: DataFrame, thresholds: DataFrame,
    alert_time: dt.datetime, driver_day: dt.date | None = None, vehicle_day: dt.date | None = None,
) -> DataFrame:
    """The four scheduled alerts in the layout of the alert table.

    With the newest day of each mart given, which stored tables know from their partitions, no rule looks for it
    again, and only the lag of the active drivers reads other days.
    """
    parts = {
        "driver_fatigue": alert_fatigue(driver_mart, dim, thresholds, driver_day),
        "vehicle_risk": alert_vehicle_risk(vehicle_mart, thresholds, vehicle_day),
        "fraud": alert_fraud(driver_mart, driver_day),
        "data_freshness": alert_freshness(driver_mart, dim, day=driver_day),
    }
    named = [df.withColumn("alert_name", F.lit(name)) for name, df in parts.items()]
    stamped = reduce(DataFrame.unionByName, named).withColumn(
        "alert_time", F.lit(alert_time).cast("timestamp_ntz")
    )
    return align(stamped, schemas.ALERTS)


def alert_digest(alerts: DataFrame, max_rows: int = 5) -> DataFrame:
    """One message per alert: total, the worst ``max_rows`` rows, and a note when there are more.

    Totals come from an ordinary aggregate and the rank filter is applied before the shuffle,
    so a flood of one alert is never gathered in one task.
    """
    worst_first = Window.partitionBy("alert_name").orderBy(
        severity_rank("severity").desc(), F.col("metric_value").desc_nulls_last(), "entity_id"
    )
    line = F.concat(
        F.coalesce("severity", F.lit("INFO")), F.lit(" | Entity: "), F.coalesce("entity_id", F.lit("?")),
        F.lit(" | Metric: "), F.coalesce("metric_name", F.lit("?")),
        F.lit(" = "), F.coalesce(F.col("metric_value").cast("string"), F.lit("?")),
        F.lit(" | Info: "), F.coalesce("description", F.lit("")),
    )
    shown = (
        alerts.withColumn("position", F.row_number().over(worst_first))
        .where(F.col("position") <= max_rows)
        .select("alert_name", "position", line.alias("line"))
        .groupBy("alert_name")
        .agg(F.sort_array(F.collect_list(F.struct("position", "line"))).alias("lines"))
    )
    totals = alerts.groupBy("alert_name").agg(F.count("*").alias("total"))
    note = F.when(
        F.col("total") > max_rows,
        F.format_string("Showing %d of %d. See dashboard for full details.", F.lit(max_rows), "total"),
    )
    return totals.join(shown, "alert_name").select(
        "alert_name",
        "total",
        F.format_string("%d alert(s) detected", "total").alias("headline"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("body"),
        note.alias("note"),
    )


def alert_timeline(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_time", "entity_id", "severity", "metric_name", "metric_value", "description"
    ).orderBy("alert_time", "entity_id", "metric_name")


# per-sample signals ------------------------------------------------------------------------

#: Length of the time slots that a vehicle's samples are cut into.
SLOT = "minute"


def harsh_brake(tel: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Flag samples whose speed fell by more than max(8, 25 %) against the previous sample.

    A vehicle may own a large share of all rows, so its sequence is cut into slots of a minute: the
    previous sample is looked up inside a slot, and only the first sample of a slot takes the last
    one of the slot before. Slots hand over within a day, days within a vehicle, so no group holds
    more than the samples of a minute, the slots of a day or the days of the calendar.
    ``carried`` (vehicle_id, event_timestamp, event_id, speed_kph) holds samples seen before
    this frame, for use across micro-batches.
    """
    slotted = tel.withColumn("slot", F.date_trunc(SLOT, "event_timestamp"))
    sample_order = ["event_timestamp", "event_id"]
    in_slot = Window.partitionBy("vehicle_id", "slot").orderBy(*sample_order)
    sequenced = slotted.withColumns(
        {
            "sample": F.struct("speed_kph").alias("sample"),
            "opens_slot": F.row_number().over(in_slot) == 1,
        }
    ).withColumn("before", F.lag("sample").over(in_slot))

    last = F.max_by(F.struct("speed_kph"), F.struct(*sample_order)).alias("last_sample")
    ends = slotted.where(F.col("slot").isNotNull()).groupBy("vehicle_id", "slot").agg(last)
    by_slot = Window.partitionBy("vehicle_id", "day").orderBy("slot")
    within = ends.withColumn("day", F.to_date("slot")).withColumn("handed", F.lag("last_sample").over(by_slot))
    days = within.groupBy("vehicle_id", "day").agg(F.max_by("last_sample", "slot").alias("last_sample"))
    if carried is not None:
        # a null day sorts first, so the carried sample precedes every day of its vehicle
        seen = carried.groupBy("vehicle_id").agg(last)
        days = days.unionByName(seen.withColumn("day", F.lit(None).cast("date")))
    sequence = days.groupBy("vehicle_id").agg(F.sort_array(F.collect_list(F.struct("day", "last_sample"))).alias("days"))
    overnight = sequence.select("vehicle_id", "days", F.posexplode("days").alias("at", "own")).select(
        "vehicle_id", F.col("own.day").alias("day"),
        F.when(F.col("at") > 0, F.get("days", F.col("at") - 1)["last_sample"]).alias("overnight"),
    )
    handover = within.join(overnight.where(F.col("day").isNotNull()), ["vehicle_id", "day"], "left").select(
        "vehicle_id", "slot", F.coalesce("handed", "overnight").alias("handed")
    )
    previous = F.when(F.col("opens_slot"), F.col("handed.speed_kph")).otherwise(F.col("before.speed_kph"))
    drop = F.col("prev_speed_kph") - F.col("speed_kph")
    return (
        sequenced.join(handover, ["vehicle_id", "slot"], "left")
        .withColumn("prev_speed_kph", previous)
        .withColumn(
            "harsh_brake",
            F.coalesce(drop > F.greatest(F.lit(8.0), F.col("prev_speed_kph") * 0.25), F.lit(False)),
        )
        .select(*tel.columns, "prev_speed_kph", "harsh_brake")
    )


def replay_buffer(tel: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` samples of every vehicle, newest first."""
    newest = Window.partitionBy("vehicle_id").orderBy(
        F.col("event_timestamp").desc(), F.col("event_id").desc()
    )
    return tel.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)


def shift_signals(df: DataFrame, limit: float = 0.6) -> DataFrame:
    """Breaks and alert list that a fatigue index implies."""
    tired = F.col("fatigue_index") >= limit
    none = F.array().cast("array<string>")
    return df.withColumns(
        {
            "breaks_taken": F.col("fatigue_index") < limit,
            "alerts": F.when(tired, F.array(F.lit("fatigue_risk"))).otherwise(none),
        }
    )


def speeding_flag(df: DataFrame, limit: float = 50) -> DataFrame:
    return df.withColumn("speeding", F.col("speed_kph") > limit)
