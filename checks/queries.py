"""Registry: key -> (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import (
    alert_queries, maintenance_queries, mart_queries, report_queries, staging_queries, stream_queries,
)
from checks.binding import Fleet

_MODULES = [
    mart_queries, maintenance_queries, staging_queries, alert_queries, report_queries, stream_queries,
]


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: sums of doubles depend on the order of addition."""
    return df.selectExpr(
        *[f"round({c}, {digits}) AS {c}" if t == "double" else c for c, t in df.dtypes]
    )


def _runner(build: Callable[[Fleet], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: round_doubles(build(Fleet(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _runner(build) for m in _MODULES for key, (build, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for m in _MODULES for key, (_, sql) in m.QUERIES.items() if sql}
