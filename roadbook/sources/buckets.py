"""State by key, in buckets: a batch reads and rewrites the buckets of its own keys only.

Each batch adds a version that holds whole buckets, and a bucket's state is the newest version of it. So what a batch
writes follows the keys it brings, and a repeated batch finds what it has found before. Two versions of a bucket stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook.sources import storage, tables

#: Number of buckets; part of the layout on storage.
BUCKETS = 64


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def touched(batch: DataFrame, key: str) -> list[int]:
    """Buckets that the keys of a batch fall into, at most all there are."""
    return sorted(row.bucket for row in batch.select(bucket_of(key).alias("bucket")).distinct().collect())


def read(
    spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None, below: int | None = None
) -> DataFrame:
    """State of some buckets or all, as it stood before version ``below``."""
    stored = _stored(spark, path)
    wanted = stored if buckets is None else [b for b in buckets if b in stored]
    folders = []
    for bucket in wanted:
        versions = [v for v in stored[bucket] if below is None or v < below]
        folders += [_folder(path, versions[0], bucket)] if versions else []
    # the limit tells the planner that there is nothing, so that joins with it go
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema).limit(0)


def write(state: DataFrame, path: str, key: str, version: int) -> None:
    """Publish whole buckets as a version. Buckets without rows here stay as they are."""
    (
        state.withColumn("bucket", bucket_of(key)).hint("rebalance", "bucket")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("bucket").parquet(f"{path}/version={version}")
    )
    stored = _stored(state.sparkSession, path)
    for bucket, versions in stored.items():
        for old in versions[2:]:
            storage.delete(state.sparkSession, _folder(path, old, bucket))
    used = {v for versions in stored.values() for v in versions[:2]}
    for old in {v for versions in stored.values() for v in versions} - used:
        storage.delete(state.sparkSession, f"{path}/version={old}")


def _folder(path: str, version: int, bucket: int) -> str:
    return f"{path}/version={version}/bucket={bucket}"


def _stored(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Committed versions of each bucket, newest first."""
    found: dict[int, list[int]] = {}
    for version in tables.committed_versions(spark, path):
        for name in storage.children(spark, f"{path}/version={version}"):
            if name.startswith("bucket="):
                found.setdefault(int(name.split("=")[1]), []).append(version)
    return found
