"""Raw drops to staged tables. Only files that are new or changed are read, once, in either mode."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook import schemas
from roadbook.operators import staging
from roadbook.sources import raw, storage, tables

# domain: raw schema, checks, staged columns, staged schema
DOMAINS = {
    "vehicles": (schemas.RAW_VEHICLES, staging.vehicle_violations, staging.vehicle_columns, schemas.STAGED_VEHICLES),
    "driver_health": (schemas.RAW_HEALTH, staging.health_violations, staging.health_columns, schemas.STAGED_HEALTH),
    "finance": (schemas.RAW_FINANCE, staging.finance_violations, staging.finance_columns, schemas.STAGED_FINANCE),
}
FILES = schemas._table(source="string", length="bigint", modified="bigint")


def stage(spark: SparkSession, domain: str, lake: str, out: str, mode: str = "strict") -> list[str]:
    """Validate and project the files of one domain, in folders of any depth, that were not staged before as they are now.

    Each file has a partition of its own, which a changed file replaces. ``strict`` fails at the
    first bad record and publishes nothing; ``quarantine`` keeps bad records with their text and
    causes in a partition beside the good ones. Finance days and their trips are published
    together; trips of a quarantined day are not staged. Returns the staged sources.
    """
    raw_schema, check, columns, _ = DOMAINS[domain]
    folder = tables.table_path(lake, domain)
    found = {_source(name): (tables.table_path(folder, name), *state) for name, *state in raw.list_raw(spark, folder)}
    known = set(staged_files(spark, out, domain))
    new = {s: f for s, f in found.items() if (s, *f[1:]) not in known}
    if not new:
        return []
    checked = check(raw.read_files(spark, [path for path, *_ in new.values()], raw_schema, below=folder))
    parts = [(domain, checked, columns())]
    if domain == "finance":
        # days and trips come from one parse, and a bad trip stops the days as well
        checked = tables.materialize(_enforced(checked, mode), "finance-days")
        days = staging.enforce(checked, "quarantine")[0]
        trips = staging.trip_violations(staging.explode_trips(days.select("event_id", "trips", "file_name")))
        trips = tables.materialize(_enforced(trips, mode), "finance-trips")
        parts = [(domain, checked, columns()), ("finance_trips", trips, staging.trip_columns())]
    for name, rows, staged in parts:
        _publish(spark, _enforced(rows, mode), staged, tables.table_path(out, name), list(new))
    entries = [(s, *state) for s, (_, *state) in new.items()]
    spark.createDataFrame(entries, FILES).write.mode("append").parquet(_files_path(out, domain))
    return sorted(new)


def _enforced(checked: DataFrame, mode: str) -> DataFrame:
    return staging.enforce(checked, "strict") if mode == "strict" else checked


def _source(name: str) -> str:
    """A short name for a file, by its path from the domain's folder on: the key of its partition."""
    return hashlib.md5(name.encode()).hexdigest()


def _publish(spark: SparkSession, rows: DataFrame, columns: list[Column], path: str, sources: list[str]) -> None:
    """Put the rows of these files in place of what an earlier or broken run has left of them."""
    for source in sources:
        storage.delete(spark, f"{path}/source={source}")
    (
        rows.select(*staging.tagged_columns(columns), F.md5(F.col("file_name").cast("binary")).alias("source"))
        .write.mode("append")
        .partitionBy("source", "quarantined")
        .parquet(path)
    )


def _files_path(out: str, domain: str) -> str:
    return tables.table_path(tables.table_path(out, "staged_files"), domain)


def staged_files(spark: SparkSession, out: str, domain: str) -> list[tuple[str, int, int]]:
    """Source, length and time of change of each staged file; of a changed file the newest state."""
    path = _files_path(out, domain)
    if not storage.exists(spark, path):
        return []
    newest: dict[str, tuple[str, int, int]] = {}
    for row in spark.read.schema(FILES).parquet(path).collect():  # one row per file, as listing has
        entry = tuple(row)
        newest[entry[0]] = max(newest.get(entry[0], entry), entry, key=lambda e: e[2])
    return sorted(newest.values())


def read_good(spark: SparkSession, out: str, domain: str, sources: list[str] | None = None) -> DataFrame:
    """Staged rows of a domain, of some files or all; other partitions are pruned."""
    schema = schemas.STAGED_TRIPS if domain == "finance_trips" else DOMAINS[domain][3]
    rows = _read(spark, out, domain, schema).where(~F.col("quarantined"))
    if sources is not None:
        rows = rows.where(F.col("source").isin(sources))
    return rows.select(*schema.names)


def read_quarantined(spark: SparkSession, out: str, domain: str) -> DataFrame:
    """Raw text and causes of the refused records."""
    schema = T.StructType().add("raw", T.StringType()).add("violations", T.ArrayType(T.StringType()))
    return _read(spark, out, domain, schema).where("quarantined").select("raw", "violations")


def _read(spark: SparkSession, out: str, domain: str, schema: T.StructType) -> DataFrame:
    with_keys = T.StructType([*schema.fields, T.StructField("source", T.StringType()), T.StructField("quarantined", T.BooleanType())])
    path = tables.table_path(out, domain)
    if not storage.exists(spark, path):
        return spark.createDataFrame([], with_keys)
    return spark.read.schema(with_keys).parquet(path)
