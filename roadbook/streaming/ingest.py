"""Streaming entry: raw drops, de-duplication, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadbook.operators.staging import tagged_columns
from roadbook.sources.raw import parse_lines


def stream_raw(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New files of a drop folder as they arrive, parsed like :func:`sources.raw.read_raw`."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.text(path), schema)


def event_time(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Zoned event time (watermarks refuse zone-less ones) and the day key."""
    return (
        df.withColumn("event_timestamp", F.col(ts_col).cast("timestamp"))
        .withColumn("date_key", F.to_date("event_timestamp"))
        .drop(ts_col)
    )


def stream_dedup(df: DataFrame, delay: str, key: str = "event_id") -> DataFrame:
    """First delivery of every event; a key is remembered for ``delay`` of event time."""
    return df.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark([key])


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Start a writer over everything that is there now, and wait for it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_quarantine(checked: DataFrame, staged: list[Column], path: str, checkpoint: str) -> StreamingQuery:
    """Good and bad records in one pass, as two partitions of one table.

    ``checked`` carries ``violations``; ``staged`` are the columns of the domain. The file sink
    commits every micro-batch exactly once.
    """
    split = checked.select(*tagged_columns(staged))
    writer = split.writeStream.format("parquet").option("path", path).partitionBy("quarantined")
    return run_available(writer, checkpoint)
