"""Upserts, dimensions, sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.binding import Fleet
from checks.oracle import sql
from roadbook import schemas
from roadbook.functions.expressions import vehicle_type
from roadbook.operators import conform, dimensions, upserts
from roadbook.plans import warehouse
from roadbook.session import scratch_path
from roadbook.sources import raw, reference, tables

# lineitem is not unique on this pair, which makes it a natural input for upserts
LINE = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_LINE_COLS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]


def _lines(f: Fleet, returned: bool | None = None) -> DataFrame:
    rows = f.table("lineitem").select(*_LINE_COLS)
    if returned is None:
        return rows
    flag = F.col("l_returnflag") == "R"
    return rows.where(flag if returned else ~flag)


def _stored(f: Fleet) -> DataFrame:
    return upserts.dedup(_lines(f, returned=False), LINE, LINE_ORDER + ["l_returnflag"])


def upsert(f: Fleet) -> DataFrame:
    """Returned lines replace the stored ones of the same key."""
    return upserts.upsert(_stored(f), _lines(f, returned=True), LINE, LINE_ORDER)


def insert_ignore(f: Fleet) -> DataFrame:
    return upserts.insert_ignore(_stored(f), _lines(f, returned=True), LINE, LINE_ORDER)


def dedup(f: Fleet) -> DataFrame:
    return upserts.dedup(_lines(f), LINE, LINE_ORDER + ["l_returnflag"])


def load_fact_replace(f: Fleet) -> DataFrame:
    """A first load with other speeds on other days, then the true rows, twice."""
    root, name = scratch_path(f.spark, "warehouse"), "fact_vehicle_telemetry"
    wrong = {"speed_kph": F.lit(0.0), "date_key": F.date_sub("date_key", 1)}
    warehouse.load_fact(f.spark, root, name, f.early("telemetry").withColumns(wrong))
    for _ in range(2):
        warehouse.load_fact(f.spark, root, name, f.telemetry)
    return tables.read_table(f.spark, root, name)


def load_fact_ignore(f: Fleet) -> DataFrame:
    """Rows of the first load stay as they are; the second brings the others."""
    root, name = scratch_path(f.spark, "warehouse"), "fact_vehicle_telemetry"
    warehouse.load_fact(f.spark, root, name, f.early("telemetry").withColumn("speed_kph", F.lit(0.0)), "ignore")
    for _ in range(2):
        warehouse.load_fact(f.spark, root, name, f.telemetry, "ignore")
    return tables.read_table(f.spark, root, name)


def reset_unseen(f: Fleet) -> DataFrame:
    return upserts.reset_unseen(f.stored_vehicles, f.telemetry)


def csv_roundtrip(f: Fleet) -> DataFrame:
    """The operational log written as CSV with a header and read back."""
    path = scratch_path(f.spark, "csv")
    log = f.vehicle_mart.select("vehicle_id", "date_key", "telemetry_events", "max_speed_kph", "speeding_events")
    tables.export_csv(log, path)
    return f.spark.read.option("header", True).schema(log.schema).csv(path)


def json_roundtrip(f: Fleet) -> DataFrame:
    """Shift facts written to the raw lake in two appends and read back as staged records."""
    path = scratch_path(f.spark, "raw")
    cut = F.col("date_key") <= F.lit("2024-01-15").cast("date")
    shifts = f.shifts.withColumn("timestamp", F.col("event_timestamp").cast("string"))
    raw.write_raw(conform.align(shifts.where(cut), schemas.STAGED_HEALTH), path, overwrite=True)
    raw.write_raw(conform.align(shifts.where(~cut), schemas.STAGED_HEALTH), path)
    staged = tables.read_staged(f.spark, path, schemas.STAGED_HEALTH, "json")
    facts = conform.to_fact(staged)
    return facts.select("event_id", "driver_id", "event_timestamp", "fatigue_index", "alerts", "date_key")


def staged_roundtrip(f: Fleet) -> DataFrame:
    """Staged telemetry replaced by a second, complete write."""
    path = scratch_path(f.spark, "staged")
    staged = conform.align(
        f.telemetry.withColumn("timestamp", F.col("event_timestamp").cast("string")), schemas.STAGED_VEHICLES
    )
    tables.write_staged(staged.where(F.col("speeding")), path)
    tables.write_staged(staged, path)
    return tables.read_staged(f.spark, path, schemas.STAGED_VEHICLES).drop("timestamp")


def fact_roundtrip(f: Fleet) -> DataFrame:
    """Date-partitioned fact: a full write, then one rewritten range of days."""
    path = scratch_path(f.spark, "fact")
    fact = conform.align(f.finance, schemas.FACT_DAILY_FINANCE)
    tables.write_fact(fact, path)
    corrected = fact.where(F.col("date_key") >= F.lit("2024-01-16").cast("date"))
    tables.write_fact(corrected.withColumn("total_cost", F.col("total_cost") + 1), path)
    stored = f.spark.read.parquet(path)
    return conform.align(stored, schemas.FACT_DAILY_FINANCE).drop("trading_position")


def replace_table(f: Fleet) -> DataFrame:
    """Two builds of the driver dimension, the second one reading the first from the same path."""
    root = scratch_path(f.spark, "dims")
    path = tables.table_path(root, "dim_driver")
    empty = tables.read_current(f.spark, root, "dim_driver")
    tables.replace_table(dimensions.build_dim_driver(empty, f.driver_master, f.early("shifts")), path)
    stored = tables.read_current(f.spark, root, "dim_driver")
    tables.replace_table(dimensions.build_dim_driver(stored, f.driver_master, f.shifts), path)
    return tables.read_current(f.spark, root, "dim_driver")


def dim_date(f: Fleet) -> DataFrame:
    return dimensions.date_attributes(reference.date_spine_over(f.table("orders"), "o_orderdate"))


def ensure_columns(f: Fleet) -> DataFrame:
    """Master drivers widened to the dimension layout."""
    return conform.ensure_columns(f.driver_master, schemas.DIM_DRIVER)


_COLS = ", ".join(_LINE_COLS)
_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity"


def _first(where: str) -> str:
    return (
        f"SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY {_ORDER}, l_returnflag) AS rn FROM lineitem {where}) WHERE rn = 1"
    )


_BASE, _NEW = _first("WHERE l_returnflag <> 'R'"), _first("WHERE l_returnflag = 'R'")
_NOT_IN = "NOT EXISTS (SELECT 1 FROM {o} o WHERE o.l_orderkey = {i}.l_orderkey AND o.l_linenumber = {i}.l_linenumber)"

QUERIES = {
    "dedup": (dedup, _first("")),
    "upsert": (
        upsert,
        sql("SELECT * FROM inc UNION ALL SELECT * FROM base WHERE " + _NOT_IN.format(o="inc", i="base"),
            base=_BASE, inc=_NEW),
    ),
    "insert_ignore": (
        insert_ignore,
        sql("SELECT * FROM base UNION ALL SELECT * FROM inc WHERE " + _NOT_IN.format(o="base", i="inc"),
            base=_BASE, inc=_NEW),
    ),
    "load_fact_replace": (
        load_fact_replace, sql("SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon) FROM tel", "tel"),
    ),
    "load_fact_ignore": (
        load_fact_ignore,
        sql("""SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon, CASE WHEN event_id IN (SELECT 'evt_' || CAST(event_id AS VARCHAR) FROM ev
                                                        WHERE event_type <> 'error' AND CAST(ts AS DATE) <= DATE '2024-01-20')
                                      THEN 0e0 ELSE speed_kph END AS speed_kph) FROM tel""", "tel", "ev"),
    ),
    "stage_master": (
        lambda f: reference.stage_master(f.driver_master, "driver_id"),
        sql("SELECT driver_id, status, status = 'ACTIVE' AS is_active FROM drv", "drv"),
    ),
    "ensure_columns": (
        ensure_columns,
        sql("SELECT driver_id, status, CAST(NULL AS TIMESTAMP) AS first_seen_at, CAST(NULL AS TIMESTAMP) AS last_seen_at FROM drv", "drv"),
    ),
    "dim_date": (
        dim_date,
        sql("""SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
                      CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
                      dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
               FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                            INTERVAL 1 DAY)) AS d FROM orders)"""),
    ),
    "dim_driver": (lambda f: f.dim_driver, sql(
        # stored rows claim 1970 as first sight, which survives only where a real last sight exists
        """SELECT driver_id, status,
                  CASE WHEN last_seen_at IS NULL THEN NULL WHEN status = 'ACTIVE' THEN TIMESTAMP '1970-01-01' ELSE first_seen_at END AS first_seen_at,
                  last_seen_at FROM ddim""", "ddim")),
    "dim_vehicle": (lambda f: f.dim_vehicle, sql("SELECT * FROM vdim", "vdim")),
    "reset_unseen": (
        reset_unseen,
        sql("""SELECT vehicle_id, 'BUS' AS vehicle_type, 'MAINTENANCE' AS status,
                      CASE WHEN vehicle_id IN (SELECT vehicle_id FROM tel) THEN TIMESTAMP '2023-06-01' END AS first_seen_at,
                      CASE WHEN vehicle_id IN (SELECT vehicle_id FROM tel) THEN TIMESTAMP '2023-06-01' END AS last_seen_at
               FROM veh WHERE status = 'ACTIVE'""", "veh", "tel"),
    ),
    "latest_activity": (
        lambda f: dimensions.latest_activity(f.shifts),
        sql("SELECT driver_id, min(event_timestamp) AS seen_first, max(event_timestamp) AS seen_last FROM shf GROUP BY driver_id", "shf"),
    ),
    "driver_master": (
        lambda f: dimensions.driver_master(f.driver_master, dimensions.latest_activity(f.shifts)),
        sql("SELECT driver_id, status, first_seen_at AS seen_first, last_seen_at AS seen_last FROM ddim", "ddim"),
    ),
    "vehicle_type": (
        lambda f: f.vehicle_master.select("vehicle_id", vehicle_type("vehicle_id").alias("vehicle_type")),
        sql("SELECT vehicle_id, vehicle_type FROM vdim", "vdim"),
    ),
    "replace_table": (replace_table, sql("SELECT * FROM ddim", "ddim")),
    "csv_roundtrip": (
        csv_roundtrip,
        sql("SELECT vehicle_id, date_key, CAST(telemetry_events AS BIGINT) AS telemetry_events, max_speed_kph, speeding_events FROM vm", "vm"),
    ),
    "json_roundtrip": (
        json_roundtrip,
        sql("""SELECT event_id, driver_id, event_timestamp, round(fatigue_index, 6) AS fatigue_index,
                      CASE WHEN alerts_json = '[]' THEN CAST([] AS VARCHAR[]) ELSE ['fatigue_risk'] END AS alerts, date_key FROM shf""", "shf"),
    ),
    "staged_roundtrip": (
        staged_roundtrip,
        sql("""SELECT event_id, vehicle_id, driver_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed_kph, 6) AS speed_kph,
                      fuel_percent, round(engine_temp_c, 6) AS engine_temp_c, round(battery_v, 6) AS battery_v, speeding FROM tel""", "tel"),
    ),
    "fact_roundtrip": (
        fact_roundtrip,
        sql("""SELECT event_id, driver_id, date_key, round(total_revenue, 6) AS total_revenue,
                      round(total_cost + CASE WHEN date_key >= DATE '2024-01-16' THEN 1 ELSE 0 END, 6) AS total_cost,
                      round(net_profit, 6) AS net_profit, fraud_alerts_count, round(total_revenue + 200, 6) AS end_of_day_balance
               FROM fin""", "fin"),
    ),
}
