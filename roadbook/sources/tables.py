"""Warehouse tables on Parquet, and the staged, CSV and alert sinks."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook import schemas
from roadbook.operators.conform import align
from roadbook.session import scratch_path
from roadbook.sources import storage


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_staged(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Staged records with their fixed schema."""
    return spark.read.schema(schema).format(fmt).load(path)


def write_staged(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the staged copy of a domain."""
    df.write.mode("overwrite").format(fmt).save(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table; an empty frame of the right shape while it does not exist yet."""
    path, schema = table_path(root, name), schemas.TABLES[name]
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_fact(df: DataFrame, path: str, partition: str = "date_key") -> set[dt.date]:
    """Overwrite exactly the day partitions present in ``df`` and return those days.

    All other partitions stay. The rebalance hint lets AQE cut a heavy day into several files
    and merge light ones. The plan must not read the days it overwrites: a crash while they are
    swapped would lose what only they hold (see ``warehouse.swap_days``).
    """
    written = Observation()
    (
        df.hint("rebalance", partition)
        # one value per calendar day, so the metric stays small
        .observe(written, F.collect_set(partition).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return set(written.get["days"])


def append_fact(df: DataFrame, path: str, partition: str = "date_key") -> None:
    """Add rows to their day partitions without rewriting what is stored."""
    df.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def days_of(df: DataFrame, partition: str = "date_key") -> list[dt.date]:
    """Distinct days, collected to prune partitions; their number is bounded by the calendar."""
    rows = df.select(partition).where(F.col(partition).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def newest_day(spark: SparkSession, root: str, name: str, partition: str = "date_key") -> dt.date | None:
    """The newest day of a stored table by the names of its partitions, without a job; emptied days have none."""
    names = storage.children(spark, table_path(root, name))
    days = [n.split("=")[1] for n in names if re.fullmatch(partition + r"=\d{4}-\d\d-\d\d", n)]
    return dt.date.fromisoformat(max(days)) if days else None


def drop_days(spark: SparkSession, path: str, days: list[dt.date], partition: str = "date_key") -> None:
    """Remove day partitions that an upsert has emptied; overwriting cannot express that."""
    for day in days:
        storage.delete(spark, f"{path}/{partition}={day.isoformat()}")


def replace_table(df: DataFrame, path: str, version: int | None = None, keep: int | None = None) -> None:
    """Publish a new version of a table.

    Each version has a folder of its own, so a plan may read the current version while it
    writes the next one; a version counts once its job has committed. A fixed ``version``
    makes a repeated micro-batch overwrite its own output. With ``keep`` only so many of the
    newest versions stay; two are enough for a batch to be repeated.
    """
    spark = df.sparkSession
    if version is None:
        version = (_newest(spark, path) or 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    if keep is not None:
        for old in _numbers(spark, path)[keep:]:
            storage.delete(spark, f"{path}/version={old}")


def read_version(spark: SparkSession, path: str, schema: T.StructType, below: int | None = None) -> DataFrame:
    """The newest version published with :func:`replace_table` (of those below a number)."""
    newest = _newest(spark, path, below)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={newest}")


def read_versions(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all committed versions, for tables to which each batch adds a version."""
    committed = committed_versions(spark, path)
    if not committed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/version={n}" for n in committed])


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_version(spark, table_path(root, name), schemas.TABLES[name])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all versions, newest first."""
    names = storage.children(spark, path)
    return sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions whose job has committed, newest first."""
    return [n for n in _numbers(spark, path) if _is_committed(spark, path, n)]


def _is_committed(spark: SparkSession, path: str, number: int) -> bool:
    return storage.exists(spark, f"{path}/version={number}/_SUCCESS")


def _newest(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest committed version; older ones are not looked at."""
    known = (n for n in _numbers(spark, path) if below is None or n < below)
    return next((n for n in known if _is_committed(spark, path, n)), None)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, for hand-over to people."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_alerts(df: DataFrame, path: str, alert_time: dt.datetime) -> None:
    """Store alert rows under their evaluation time; a repeated evaluation replaces its rows.

    The partition's folder is written directly, so an evaluation without alerts clears it as well.
    """
    stamped = df.withColumn("alert_time", F.lit(alert_time).cast("timestamp_ntz"))
    stamp = alert_time.isoformat(sep=" ").replace(":", "%3A")
    align(stamped, schemas.ALERTS).drop("alert_time").write.mode("overwrite").parquet(f"{path}/alert_time={stamp}")
