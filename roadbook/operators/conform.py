"""Shape helpers: by-name alignment, added columns, identity filters, fact derivation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types; missing ones become typed nulls."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema
        ]
    )


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, keeping everything it has."""
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose identity columns are all present."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in cols]))


def to_fact(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Rename the raw timestamp text and derive the day key.

    Offsets in the text are honoured and the result is UTC wall-clock time (the session
    runs in UTC). A column that already is a plain date only becomes the key.
    """
    if ts_col == "date":
        return df.withColumn("date_key", F.to_date("date")).drop("date")
    stamp = F.col(ts_col).cast("timestamp").cast("timestamp_ntz")
    return (
        df.withColumn("event_timestamp", stamp)
        .withColumn("date_key", F.to_date("event_timestamp"))
        .drop(ts_col)
    )
