"""Reusable column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

EPOCH_START = dt.date(1900, 1, 1)


def vehicle_type(vehicle_id: str | Column) -> Column:
    """Type from the id prefix."""
    vid = F.col(vehicle_id) if isinstance(vehicle_id, str) else vehicle_id
    return (
        F.when(vid.startswith("BUS"), F.lit("BUS"))
        .when(vid.startswith("CAR"), F.lit("CAR"))
        .otherwise(F.lit("UNKNOWN"))
    )


def rate(part: str | Column, whole: str | Column) -> Column:
    """Share as a double; null when the whole is zero or null."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))


def high_water(mart: DataFrame, date_col: str = "date_key") -> Column:
    """Newest day in a mart as a scalar subquery; a day before all data when it is empty."""
    newest = F.coalesce(F.max(date_col), F.lit(EPOCH_START))
    return mart.select(newest.alias("high_water")).scalar()


def latest_day(df: DataFrame, date_col: str = "date_key") -> Column:
    """Newest day as a scalar subquery; prunes partitions when ``df`` is a partitioned table."""
    return df.select(F.max(date_col).alias("latest_day")).scalar()


def latest(df: DataFrame, date_col: str = "date_key", day: dt.date | None = None) -> DataFrame:
    """Rows of the newest day; where that is known already, ``day`` spares looking for it and prunes while planning."""
    return df.where(F.col(date_col) == (latest_day(df, date_col) if day is None else F.lit(day)))


def trailing(df: DataFrame, days: int, date_col: str = "date_key") -> DataFrame:
    """Rows from ``days`` before the newest day on: ``days`` + 1 calendar dates."""
    return df.where(F.col(date_col) >= F.date_sub(latest_day(df, date_col), days))


def date_range(
    df: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
    as_of: dt.date | None = None, days: int = 7, date_col: str = "date_key",
) -> DataFrame:
    """Inclusive date filter; without bounds the ``days`` up to ``as_of``."""
    if start is None or end is None:
        if as_of is None:
            raise ValueError("give start and end, or as_of")
        start, end = as_of - dt.timedelta(days=days), as_of
    return df.where(F.col(date_col).between(F.lit(start), F.lit(end)))


def threshold(
    thresholds: DataFrame, metric: str, kind: str = "warning", default: float | None = None
) -> Column:
    """Limit of one metric as a scalar subquery, with a fallback where it is not configured."""
    limit = (
        thresholds.where(F.col("metric_name") == metric)
        .select(F.max(f"{kind}_threshold").alias(f"{metric}_{kind}"))
        .scalar()
    )
    return limit if default is None else F.coalesce(limit, F.lit(float(default)))


def threshold_text(thresholds: DataFrame, metric: str) -> Column:
    """Description of one metric."""
    return (
        thresholds.where(F.col("metric_name") == metric)
        .select(F.max("description").alias("text"))
        .scalar()
    )
