"""Loading facts, building dimensions and refreshing marts on stored tables.

Only the day partitions that change are read and written. Days are collected to the driver
(their number is bounded by the calendar) so that pruning happens while planning.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook import schemas
from roadbook.functions.expressions import EPOCH_START
from roadbook.operators import dimensions, marts, upserts
from roadbook.operators.conform import align, drop_null_keys
from roadbook.sources import keyindex, storage, tables

# identity columns a stored fact row must have
IDENTITY = {
    "fact_vehicle_telemetry": ["event_id", "vehicle_id", "date_key"],
    "fact_driver_shifts": ["event_id", "driver_id", "date_key"],
    "fact_daily_finance": ["event_id", "driver_id", "date_key"],
}

# facts that tell when an entity was seen
ENTITY = {"fact_driver_shifts": "driver_id", "fact_vehicle_telemetry": "vehicle_id"}
MARTS = ["fact_driver_daily_metrics", "fact_vehicle_daily_metrics"]


def load_fact(
    spark: SparkSession, root: str, name: str, incoming: DataFrame, on_conflict: str = "replace"
) -> None:
    """Load a batch into a fact table and note the entity-days whose marts it puts out of date.

    The keys of a load are noted in a folder of its own before the fact changes, and stay noted
    until :func:`refresh_marts` has dealt with them. A run that dies in between loses none.

    Known ids are found through the fact's key index, which names the days to look into; no other day is read. Ids
    are entered there before their rows are stored, so facts have to be written through this function.

    ``replace``: a known event id is replaced where its row differs, even when its day has
    changed; only the days of such rows are rewritten, and a row stored before as it is changes
    nothing. ``ignore``: known ids are skipped. New rows are appended in either case.
    """
    path, schema = tables.table_path(root, name), schemas.TABLES[name]
    recover_swaps(spark, root, name)
    keyed = drop_null_keys(align(incoming, schema), IDENTITY[name])
    # events have no natural order inside a batch: all columns make the choice reproducible
    order = [F.to_json(c) if _is_array(schema, c) else c for c in schema.names]
    entities = _entities(schema)
    if on_conflict not in ("replace", "ignore"):
        raise ValueError(f"unknown conflict rule {on_conflict!r}")
    fresh = tables.materialize(upserts.dedup(keyed, ["event_id"], order), name)
    met = _met_days(spark, root, name, fresh)
    stored = _days(tables.read_table(spark, root, name), met)

    if on_conflict == "ignore":
        added = fresh.select(*schema.names)
        if met:
            added = tables.materialize(added.join(stored.select("event_id"), "event_id", "left_anti").select(*schema.names), name)
        _note(root, name, added.select(*entities))
        keyindex.note(spark, root, name, added)
        tables.append_fact(added, path)
        return

    known = tables.materialize(stored.join(fresh.select("event_id"), "event_id", "left_semi"), f"{name}-known")
    same = reduce(and_, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in schema.names])
    paired = fresh.alias("new").join(known.alias("old"), F.col("new.event_id") == F.col("old.event_id"), "left")
    differing = tables.materialize(
        paired.where(~same).select("new.*", F.col("old.event_id").isNotNull().alias("replaces")), f"{name}-new"
    )
    changed = differing.where("replaces").select("event_id")
    replaced = known.join(changed, "event_id", "left_semi")
    _note(root, name, differing.select(*entities).unionByName(replaced.select(*entities)))
    keyindex.note(spark, root, name, differing)
    days = tables.days_of(replaced)
    if days:
        # days that lose a row are rewritten with their new rows; the other new rows are appended
        kept = upserts.delete_keys(_days(stored, days), changed, ["event_id"])
        entering = _days(differing, days).select(*schema.names)
        swap_days(spark, root, name, kept.unionByName(entering), days)
    rest = differing.where(~F.col("date_key").isin(days)) if days else differing
    tables.append_fact(rest.select(*schema.names), path)


def stored_like(spark: SparkSession, root: str, name: str, ids: DataFrame) -> DataFrame:
    """The stored rows of the days that may hold an event id of ``ids``."""
    return _days(tables.read_table(spark, root, name), _met_days(spark, root, name, ids))


def _met_days(spark: SparkSession, root: str, name: str, ids: DataFrame) -> list[dt.date]:
    return tables.days_of(keyindex.locate(spark, root, name, ids))


FILES = schemas._table(source="string", length="bigint", modified="bigint")


def loaded_files(spark: SparkSession, root: str, domain: str) -> list[tuple[str, int, int]]:
    """Staged files whose rows the fact holds."""
    path = _loaded_path(root, domain)
    if not storage.exists(spark, path):
        return []
    return [tuple(row) for row in spark.read.schema(FILES).parquet(path).collect()]


def note_loaded(spark: SparkSession, root: str, domain: str, files: list[tuple[str, int, int]]) -> None:
    spark.createDataFrame(files, FILES).write.mode("append").parquet(_loaded_path(root, domain))


def _loaded_path(root: str, domain: str) -> str:
    return tables.table_path(tables.table_path(root, "loaded_files"), domain)


def swap_days(spark: SparkSession, root: str, name: str, rows: DataFrame, days: list[dt.date]) -> None:
    """Replace day partitions by ``rows``, which may be read from these partitions.

    Their next state is complete on storage before the table is touched, and is applied again by
    :func:`recover_swaps` if a run dies while the days are moved.
    """
    path = tables.table_path(_swap_path(root, name), uuid.uuid4().hex)
    rows.write.parquet(f"{path}/rows")
    spark.createDataFrame([(d,) for d in days], "date_key date").write.parquet(f"{path}/days")
    _apply_swap(spark, root, name, path)


def recover_swaps(spark: SparkSession, root: str, name: str) -> None:
    """Finish replacements that a run has begun; drop those it had not completed on storage."""
    for child in storage.children(spark, _swap_path(root, name)):
        path = tables.table_path(_swap_path(root, name), child)
        if storage.exists(spark, f"{path}/days/_SUCCESS"):
            _apply_swap(spark, root, name, path)
        else:
            storage.delete(spark, path)


def _apply_swap(spark: SparkSession, root: str, name: str, path: str) -> None:
    rows = spark.read.schema(schemas.TABLES[name]).parquet(f"{path}/rows")
    days = tables.days_of(spark.read.schema("date_key date").parquet(f"{path}/days"))
    target = tables.table_path(root, name)
    written = tables.write_fact(rows, target)
    tables.drop_days(spark, target, [d for d in days if d not in written])
    storage.delete(spark, path)


def _swap_path(root: str, name: str) -> str:
    return tables.table_path(tables.table_path(root, "swaps"), name)


def _entities(schema: T.StructType) -> list[str]:
    return [c for c in ("vehicle_id", "driver_id", "date_key") if c in schema.names]


def _pending_path(root: str, name: str, load: str = "") -> str:
    return tables.table_path(tables.table_path(tables.table_path(root, "pending_keys"), name), load).rstrip("/")


def _note(root: str, name: str, keys: DataFrame) -> None:
    keys.distinct().write.parquet(_pending_path(root, name, uuid.uuid4().hex))


def pending_loads(spark: SparkSession, root: str, name: str) -> list[str]:
    """Loads of one fact whose keys the marts have not caught up with."""
    loads = storage.children(spark, _pending_path(root, name))
    return sorted(n for n in loads if storage.exists(spark, f"{_pending_path(root, name, n)}/_SUCCESS"))


def pending(spark: SparkSession, root: str, name: str, loads: list[str] | None = None) -> DataFrame:
    """Entity-days noted by these loads of a fact (all by default)."""
    return _noted(spark, root, name, loads).distinct()


def _noted(spark: SparkSession, root: str, name: str, loads: list[str] | None = None) -> DataFrame:
    """Like :func:`pending`, each key once a load; enough to list days."""
    fact = schemas.TABLES[name]
    keys = T.StructType([fact[c] for c in _entities(fact)])
    loads = pending_loads(spark, root, name) if loads is None else loads
    if not loads:
        return spark.createDataFrame([], keys)
    return spark.read.schema(keys).parquet(*[_pending_path(root, name, n) for n in loads])


def settle(spark: SparkSession, root: str, loads: dict[str, list[str]]) -> None:
    """Forget what exactly these loads have noted; loads that came meanwhile stay."""
    for name, own in loads.items():
        for load in own:
            storage.delete(spark, _pending_path(root, name, load))


def refresh_marts(spark: SparkSession, root: str, policy: str = "touched_keys") -> None:
    """Bring both marts up to date with what all loads of all facts have noted so far.

    ``touched_keys`` recomputes each noted day. ``high_watermark`` adds the days after the newest
    stored one; keys of earlier days stay noted, as their marts remain out of date.
    """
    loads = {name: pending_loads(spark, root, name) for name in IDENTITY}
    for name in ENTITY:
        refresh_activity(spark, root, name)
    if policy == "high_watermark":
        marks = {mart: _mark(spark, root, mart) for mart in MARTS}
        refresh_driver_mart(spark, root, policy)
        refresh_vehicle_mart(spark, root, policy)
        newest = max(marks.values())
        for name, own in loads.items():
            if own:
                _note(root, name, pending(spark, root, name, own).where(F.col("date_key") <= F.lit(newest)))
        settle(spark, root, loads)
        return
    # marts are written by whole days, so of the noted keys only the days count; their number is bounded by the calendar
    noted = {name: tables.days_of(_noted(spark, root, name, own)) for name, own in loads.items()}
    refresh_driver_mart(spark, root, policy, _day_rows(spark, sorted(set().union(*noted.values()))))
    refresh_vehicle_mart(spark, root, policy, _day_rows(spark, noted["fact_vehicle_telemetry"]))
    settle(spark, root, loads)


def _day_rows(spark: SparkSession, days: list[dt.date]) -> DataFrame:
    return spark.createDataFrame([(day,) for day in days], "date_key date")


def refresh_driver_mart(
    spark: SparkSession, root: str, policy: str = "high_watermark", touched: DataFrame | None = None
) -> None:
    """Bring the stored driver mart up to date; policies as in ``marts.refresh_driver``."""
    facts = [tables.read_table(spark, root, n) for n in IDENTITY]
    dim = tables.read_current(spark, root, "dim_driver")
    _refresh(
        spark, root, "fact_driver_daily_metrics", policy, touched,
        lambda days: marts.driver_daily_metrics(*(days(f) for f in facts), dim),
    )


def refresh_vehicle_mart(
    spark: SparkSession, root: str, policy: str = "high_watermark", touched: DataFrame | None = None
) -> None:
    tel = tables.read_table(spark, root, "fact_vehicle_telemetry")
    thresholds = tables.read_current(spark, root, "alert_thresholds")
    _refresh(
        spark, root, "fact_vehicle_daily_metrics", policy, touched,
        lambda days: marts.vehicle_daily_metrics(days(tel), thresholds),
    )


def refresh_activity(spark: SparkSession, root: str, name: str) -> None:
    """Recompute, for the days noted by any load, when each entity was first and last seen on the day.

    Dimensions are built from these few rows instead of the complete fact. Days are computed whole
    from the fact, so a repeated or broken run does no harm; settling comes after it.
    """
    days, path = tables.days_of(_noted(spark, root, name)), _activity_path(root, name)
    if not days:
        return
    entity = ENTITY[name]
    seen = _days(tables.read_table(spark, root, name), days).groupBy(entity, "date_key").agg(
        F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last")
    )
    written = tables.write_fact(seen, path)
    tables.drop_days(spark, path, [d for d in days if d not in written])


def activity(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Entity and event time: the first and the last event of each entity and day."""
    schema = f"{ENTITY[name]} string, first timestamp_ntz, last timestamp_ntz, date_key date"
    path = _activity_path(root, name)
    rows = spark.read.schema(schema).parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], schema)
    return rows.select(ENTITY[name], F.explode(F.array("first", "last")).alias("event_timestamp"))


def _activity_path(root: str, name: str) -> str:
    return tables.table_path(tables.table_path(root, "activity"), name)


def _mark(spark: SparkSession, root: str, mart: str) -> dt.date:
    return tables.read_table(spark, root, mart).agg(F.max("date_key")).first()[0] or EPOCH_START


def _refresh(
    spark: SparkSession, root: str, name: str, policy: str, touched: DataFrame | None,
    compute: Callable[[Callable[[DataFrame], DataFrame]], DataFrame],
) -> None:
    """Write whole days computed from the facts alone: no stored mart row is read.

    A day that dies half written is still noted, so the next refresh writes it again.
    """
    path = tables.table_path(root, name)
    if policy == "high_watermark":
        mark = _mark(spark, root, name)
        tables.write_fact(compute(lambda fact: fact.where(F.col("date_key") > F.lit(mark))), path)
        return
    if policy != "touched_keys" or touched is None:
        raise ValueError("touched_keys needs the touched key set")
    days = tables.days_of(touched)
    if not days:
        return
    written = tables.write_fact(compute(lambda fact: _days(fact, days)), path)
    tables.drop_days(spark, path, [d for d in days if d not in written])


def _days(df: DataFrame, days: list[dt.date]) -> DataFrame:
    return df.where(F.col("date_key").isin(days))


def _is_array(schema: T.StructType, column: str) -> bool:
    return schema[column].dataType.typeName() == "array"


def build_dimensions(
    spark: SparkSession, root: str, drivers: DataFrame, vehicles: DataFrame,
    start: dt.date = dt.date(2025, 1, 1), end: dt.date = dt.date(2027, 12, 31),
) -> None:
    """Next version of the three dimensions; history of earlier versions stays readable.

    The calendar covers ``start`` to ``end`` and is extended to the days that the facts hold.
    """
    for name in ENTITY:
        refresh_activity(spark, root, name)
    for name in IDENTITY:
        low, high = tables.read_table(spark, root, name).agg(F.min("date_key"), F.max("date_key")).first()
        start, end = min(start, low or start), max(end, high or end)
    builds = {
        "dim_date": upserts.insert_ignore(
            tables.read_current(spark, root, "dim_date"),
            dimensions.build_dim_date(spark, start, end), ["date_key"], ["date_key"],
        ),
        "dim_driver": dimensions.build_dim_driver(
            tables.read_current(spark, root, "dim_driver"), drivers,
            activity(spark, root, "fact_driver_shifts"),
        ),
        "dim_vehicle": dimensions.build_dim_vehicle(
            tables.read_current(spark, root, "dim_vehicle"), vehicles,
            activity(spark, root, "fact_vehicle_telemetry"),
        ),
    }
    for name, df in builds.items():
        tables.replace_table(df, tables.table_path(root, name))


def seed_thresholds(spark: SparkSession, root: str, seed: DataFrame) -> None:
    """Seed rows replace stored rows of the same metric; other metrics stay."""
    stored = tables.read_current(spark, root, "alert_thresholds")
    merged = upserts.upsert(stored, seed, ["metric_name"], ["warning_threshold"])
    tables.replace_table(merged, tables.table_path(root, "alert_thresholds"))
