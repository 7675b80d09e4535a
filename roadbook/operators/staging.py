"""Validation and projection of raw records.

Input frames come from :mod:`roadbook.sources.raw`: typed columns plus ``present_keys``.
A violation is a short code, so that quarantined rows can be grouped by cause.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from roadbook import schemas
from roadbook.sources.raw import parse_lines

# Keys a record has to carry.
VEHICLE_KEYS = ["event_id", "vehicle_id", "driver_id", "timestamp", "lat", "lon"]
HEALTH_KEYS = ["event_id", "driver_id", "timestamp"]
FINANCE_KEYS = ["event_id", "driver_id", "date", "total_revenue", "total_cost", "net_profit"]
TRIP_KEYS = ["event_id", "driver_id", "timestamp", "revenue", "total_cost"]


def missing_keys(present: Column | str, required: list[str]) -> Column:
    """Required keys that the JSON object does not carry. Unparsable text lacks all of them."""
    present = F.col(present) if isinstance(present, str) else present
    wanted = F.array(*[F.lit(k) for k in required])
    return F.array_except(wanted, F.coalesce(present, F.array().cast("array<string>")))


def _with_violations(df: DataFrame, required: list[str], **rules: Column) -> DataFrame:
    absent = F.transform(
        missing_keys("present_keys", required), lambda k: F.concat(F.lit("missing_"), k)
    )
    wrong = F.transform("bad_types", lambda k: F.concat(F.lit("bad_type_"), k))
    # a rule that evaluates to null is not broken
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules.items()]))
    return df.withColumn("violations", F.concat(absent, F.coalesce(wrong, F.array().cast("array<string>")), broken))


def _outside(name: str, low: float, high: float) -> Column:
    return ~F.col(name).between(low, high)


def _carried_null(name: str) -> Column:
    """Key present with an explicit null, where a number is needed."""
    return F.col(name).isNull() & F.array_contains("present_keys", name) & ~F.array_contains("bad_types", name)


def _identity(*names: str) -> dict[str, Column]:
    """Identity that is explicitly null: such a row could not be stored."""
    return {f"null_{n}": F.col(n).isNull() & F.array_contains("present_keys", n) for n in names}


def _bad_time(name: str, kind: str = "timestamp") -> Column:
    """A text that is no time; it would stop every later load."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def vehicle_violations(df: DataFrame) -> DataFrame:
    return _with_violations(
        df,
        VEHICLE_KEYS,
        lat_out_of_range=_outside("lat", -90, 90) | _carried_null("lat"),
        lon_out_of_range=_outside("lon", -180, 180) | _carried_null("lon"),
        speed_negative=F.col("speed_kph") < 0,
        fuel_out_of_range=_outside("fuel_percent", 0, 100),
        bad_time=_bad_time("timestamp"),
        **_identity("event_id", "vehicle_id", "timestamp"),
    )


def health_violations(df: DataFrame) -> DataFrame:
    return _with_violations(
        df,
        HEALTH_KEYS,
        shift_hours_negative=F.col("shift_hours") < 0,
        continuous_hours_negative=F.col("continuous_driving_hours") < 0,
        fatigue_out_of_range=_outside("fatigue_index", 0, 1),
        bad_time=_bad_time("timestamp"),
        **_identity("event_id", "driver_id", "timestamp"),
    )


def finance_violations(df: DataFrame) -> DataFrame:
    return _with_violations(
        df,
        FINANCE_KEYS,
        revenue_negative=(F.col("total_revenue") < 0) | _carried_null("total_revenue"),
        cost_negative=(F.col("total_cost") < 0) | _carried_null("total_cost"),
        bad_time=_bad_time("date", "date"),
        **_identity("event_id", "driver_id", "date"),
    )


def trip_violations(df: DataFrame) -> DataFrame:
    return _with_violations(
        df,
        TRIP_KEYS,
        revenue_negative=(F.col("revenue") < 0) | _carried_null("revenue"),
        cost_negative=(F.col("total_cost") < 0) | _carried_null("total_cost"),
        bad_time=_bad_time("timestamp"),
    )


def enforce(df: DataFrame, mode: str = "strict") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Act on ``violations``.

    ``strict``: the job that reads the result fails at the first bad record, without an extra
    pass. ``quarantine``: (good, bad), two filters over the same frame; each parses the lines that it
    is read from, so who needs both sides takes :func:`tagged_columns`.
    """
    clean = F.size("violations") == 0
    if mode == "strict":
        complaint = F.concat(
            F.lit("Invalid record: "), F.array_join("violations", ", "),
            F.lit(" in "), F.coalesce(F.col("value"), F.lit("(no text)")),
        )
        return df.where(F.when(clean, F.lit(True)).otherwise(F.raise_error(complaint).cast("boolean")))
    if mode == "quarantine":
        return df.where(clean), df.where(~clean)
    raise ValueError(f"unknown mode {mode!r}")


def _or_default(name: str, default: Column) -> Column:
    """Default only where the key is absent; an explicit null stays null."""
    return F.when(F.array_contains("present_keys", name), F.col(name)).otherwise(default)


def _columns(schema: T.StructType, **overrides: Column) -> list[Column]:
    return [overrides.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema]


def vehicle_columns() -> list[Column]:
    return _columns(
        schemas.STAGED_VEHICLES,
        lat=F.round("lat", 6),
        lon=F.round("lon", 6),
        speeding=_or_default("speeding", F.lit(False)),
    )


def health_columns() -> list[Column]:
    no_alerts = F.array().cast("array<string>")
    return _columns(schemas.STAGED_HEALTH, alerts=_or_default("alerts", no_alerts))


def finance_columns() -> list[Column]:
    count = _or_default("fraud_alerts_count", F.lit(0.0))
    return _columns(schemas.STAGED_FINANCE, fraud_alerts_count=count)


def trip_columns() -> list[Column]:
    return _columns(
        schemas.STAGED_TRIPS,
        trip_event_id=F.col("event_id"),
        fraud_alert=_or_default("fraud_alert", F.lit(False)),
    )


def stage_vehicles(df: DataFrame) -> DataFrame:
    return df.select(*vehicle_columns())


def stage_driver_health(df: DataFrame) -> DataFrame:
    return df.select(*health_columns())


def stage_finance_daily(df: DataFrame) -> DataFrame:
    return df.select(*finance_columns())


def explode_trips(df: DataFrame) -> DataFrame:
    """One row per nested trip, parsed like a record of its own; no list means no rows."""
    kept = [c for c in ("file_name",) if c in df.columns]
    trips = df.select(F.col("event_id").alias("daily_event_id"), F.explode("trips").alias("value"), *kept)
    return parse_lines(trips, schemas.RAW_TRIP)


def stage_finance_trips(df: DataFrame) -> DataFrame:
    """Staged trips from the output of :func:`explode_trips`."""
    return df.select(*trip_columns())


def tagged_columns(staged: list[Column]) -> list[Column]:
    """Staged columns of good *and* bad records; the bad ones keep their text and causes."""
    bad = F.size("violations") > 0
    return [
        *staged, F.when(bad, F.col("value")).alias("raw"), F.col("violations"), bad.alias("quarantined"),
    ]
