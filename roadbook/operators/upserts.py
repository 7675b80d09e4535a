"""Key-based table maintenance as joins.

Plain Parquet takes no MERGE or DELETE, so each operator returns the next state of the table.
Joins carry no hints: the planner broadcasts the incoming side when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedup(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key under ``order``.

    The rank filter is applied before the shuffle as well, so a hot key sends one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def upsert(base: DataFrame, incoming: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Incoming rows replace stored rows of the same key."""
    fresh = dedup(incoming, keys, order)
    return base.join(fresh.select(*keys), keys, "left_anti").select(*base.columns).unionByName(fresh)


def insert_ignore(base: DataFrame, incoming: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Stored rows win; only unknown keys are added."""
    return base.unionByName(new_rows(base, incoming, keys, order))


def new_rows(base: DataFrame, incoming: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Incoming rows whose key the table does not hold yet."""
    fresh = dedup(incoming, keys, order)
    return fresh.join(base.select(*keys), keys, "left_anti").select(*incoming.columns)


def delete_keys(base: DataFrame, keyset: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not listed."""
    return base.join(keyset.select(*keys), keys, "left_anti").select(*base.columns)


def merge_driver(dim: DataFrame, source: DataFrame) -> DataFrame:
    """Overwrite driver status, keep known timestamps where the source has none.

    ``source``: driver_id, status, seen_first, seen_last.
    """
    return _merge(dim, source, "driver_id").select(
        "driver_id",
        "status",
        F.coalesce("first_seen_at", "seen_first").alias("first_seen_at"),
        F.coalesce("seen_last", "last_seen_at").alias("last_seen_at"),
    )


def merge_vehicle(dim: DataFrame, master: DataFrame, vehicle_type: Column) -> DataFrame:
    """Overwrite vehicle status and type; new vehicles start without timestamps."""
    source = master.select("vehicle_id", "status", vehicle_type.alias("new_type"))
    return _merge(dim, source, "vehicle_id").select(
        "vehicle_id",
        F.when(F.col("listed"), F.col("new_type")).otherwise(F.col("vehicle_type")).alias("vehicle_type"),
        "status",
        "first_seen_at",
        "last_seen_at",
    )


def _merge(dim: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full outer join on ``key`` with the status of the source where it lists the key."""
    tagged = source.withColumnRenamed("status", "new_status").withColumn("listed", F.lit(True))
    both = dim.join(tagged, key, "full_outer").withColumn("listed", F.coalesce("listed", F.lit(False)))
    status = F.when(F.col("listed"), F.col("new_status")).otherwise(F.col("status"))
    return both.withColumn("status", status)


def null_epoch(df: DataFrame, null_when_missing: bool = True) -> DataFrame:
    """Blank both timestamps where the last one is a 1970-or-earlier default.

    With ``null_when_missing`` a missing last timestamp blanks the first one too.
    """
    plausible = F.year("last_seen_at") > 1970
    if not null_when_missing:
        plausible = plausible | F.col("last_seen_at").isNull()
    return df.withColumns(
        {c: F.when(plausible, F.col(c)) for c in ("first_seen_at", "last_seen_at")}
    )


def reset_unseen(dim: DataFrame, fact: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Blank both timestamps of members that never occur in the fact."""
    seen = fact.where(F.col(key).isNotNull()).select(key).distinct().withColumn("seen", F.lit(True))
    return (
        dim.join(seen, key, "left")
        .withColumns({c: F.when(F.col("seen"), F.col(c)) for c in ("first_seen_at", "last_seen_at")})
        .select(*dim.columns)
    )
