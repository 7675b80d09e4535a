"""Structured Streaming runs over the events, each compared with its batch meaning.

The events are dropped as raw JSON lines into a fresh folder below the shared scratch
location and consumed with ``availableNow``; results are read back from the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from checks.binding import Fleet
from checks.oracle import DRIVER_MART, VEHICLE_MART, rounded, sql
from checks.staging_queries import _CLEAN_V, _CODES, _RAWV
from roadbook import schemas
from roadbook.operators import staging
from roadbook.operators.conform import align
from roadbook.plans import warehouse
from roadbook.session import scratch_path
from roadbook.sources import raw, tables
from roadbook.streaming import ingest, live, stateful


def _drop(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Telemetry facts as a raw drop."""
    lines = df.withColumn("timestamp", F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    raw.write_raw(align(lines, schemas.STAGED_VEHICLES), path, overwrite)


def _stream(f: Fleet, path: str, max_files: int | None = None) -> DataFrame:
    return ingest.event_time(ingest.stream_raw(f.spark, path, schemas.RAW_VEHICLES, max_files))


def _collect(f: Fleet, df: DataFrame) -> DataFrame:
    """Run a stream into a table and read the table back."""
    out, checkpoint = scratch_path(f.spark, "out"), scratch_path(f.spark, "ckpt")
    ingest.run_available(df.writeStream.format("parquet").option("path", out), checkpoint)
    return f.spark.read.schema(df.schema).parquet(out)


def stream_dedup(f: Fleet) -> DataFrame:
    """The whole drop is delivered twice; every event comes out once."""
    path = scratch_path(f.spark, "drop")
    _drop(f.telemetry, path)
    _drop(f.telemetry, path, overwrite=False)
    once = ingest.stream_dedup(_stream(f, path, max_files=1), "60 days")
    return _collect(f, once.select("event_id", "vehicle_id", "event_timestamp", "speed_kph")).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")
    )


def stream_vehicle_daily(f: Fleet) -> DataFrame:
    """Two drops, the second with late rows of days that are stored already."""
    path, root, checkpoint = (scratch_path(f.spark, n) for n in ("drop", "live", "ckpt"))
    for part in (f.early("telemetry"), f.late("telemetry")):
        _drop(part, path, overwrite=False)
        figures = live.stream_vehicle_daily(_stream(f, path), "60 days")
        ingest.run_available(figures.writeStream.foreachBatch(live.keep_vehicle_daily(root)).outputMode("update"), checkpoint)
    return tables.read_table(f.spark, root, "live_vehicle_daily")


def stream_alerts(f: Fleet) -> DataFrame:
    path = scratch_path(f.spark, "drop")
    _drop(f.telemetry, path)
    found = live.stream_alerts(_stream(f, path), f.thresholds, f.vehicle_master)
    return _collect(f, found).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def stream_alerts_live(f: Fleet) -> DataFrame:
    """Early samples in a batch without rules, so that nothing is found; all again once rules and vehicles are there."""
    path, root, out, checkpoint = (scratch_path(f.spark, n) for n in ("drop", "warehouse", "out", "ckpt"))
    job = live.keep_alerts(root, out)
    _drop(f.early("telemetry"), path)
    ingest.run_available(_stream(f, path).writeStream.foreachBatch(job), checkpoint)
    warehouse.seed_thresholds(f.spark, root, f.thresholds)
    warehouse.build_dimensions(f.spark, root, f.driver_master, f.vehicle_master)
    _drop(f.telemetry, path, overwrite=False)
    ingest.run_available(_stream(f, path).writeStream.foreachBatch(job), checkpoint)
    alerts = "entity_id string, entity_type string, metric_name string, metric_value double, severity string, description string"
    found = tables.read_versions(f.spark, out, f"{alerts}, event_id string, event_timestamp timestamp")
    return found.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def stream_refresh(f: Fleet) -> DataFrame:
    """Early facts in the first drop, late and new ones in the second; final vehicle mart."""
    path, root, checkpoint = (scratch_path(f.spark, n) for n in ("drop", "warehouse", "ckpt"))
    warehouse.seed_thresholds(f.spark, root, f.thresholds)
    for part in (f.early("telemetry"), f.late("telemetry")):
        _drop(part, path, overwrite=False)
        job = stateful.stream_refresh(root)
        ingest.run_available(_stream(f, path).writeStream.foreachBatch(job), checkpoint)
    return tables.read_table(f.spark, root, "fact_vehicle_daily_metrics")


def stream_refresh_driver_mart(f: Fleet) -> DataFrame:
    """Streams of all three facts over one warehouse, each in two drops; final driver mart."""
    root = scratch_path(f.spark, "warehouse")
    warehouse.seed_thresholds(f.spark, root, f.thresholds)
    warehouse.build_dimensions(f.spark, root, f.driver_master, f.vehicle_master)
    facts = {"telemetry": "fact_vehicle_telemetry", "shifts": "fact_driver_shifts", "finance": "fact_daily_finance"}
    for name, fact in facts.items():
        path, checkpoint = scratch_path(f.spark, "drop"), scratch_path(f.spark, "ckpt")
        for part in (f.early(name), f.late(name)):
            align(part, schemas.TABLES[fact]).write.mode("append").parquet(path)
            rows = f.spark.readStream.schema(schemas.TABLES[fact]).parquet(path)
            ingest.run_available(rows.writeStream.foreachBatch(stateful.stream_refresh(root, fact)), checkpoint)
    return tables.read_table(f.spark, root, "fact_driver_daily_metrics")


def _harsh_brake(f: Fleet, parts: list[Column], delay: str) -> DataFrame:
    path, out, state, checkpoint = (scratch_path(f.spark, n) for n in ("drop", "out", "state", "ckpt"))
    for part in parts:
        _drop(f.telemetry.where(part), path, overwrite=False)
        job = stateful.stream_harsh_brake(out, state, delay)
        ingest.run_available(_stream(f, path).writeStream.foreachBatch(job), checkpoint)
    return stateful.read_harsh_brake(f.spark, out).select("event_id", "vehicle_id", "prev_speed_kph", "harsh_brake")


def stream_harsh_brake(f: Fleet) -> DataFrame:
    """Two drops in time order; the flags equal the batch result."""
    cut = F.col("date_key") <= F.lit("2024-01-15").cast("date")
    return _harsh_brake(f, [cut, ~cut], "1 hour")


def stream_harsh_brake_late(f: Fleet) -> DataFrame:
    """Two drops that each hold samples between those of the other; the flags equal the batch result."""
    early = F.xxhash64("event_id") % 2 == 0
    return _harsh_brake(f, [early, ~early], "60 days")


def stream_replay_buffer(f: Fleet) -> DataFrame:
    path, state, checkpoint = (scratch_path(f.spark, n) for n in ("drop", "state", "ckpt"))
    cut = F.col("date_key") <= F.lit("2024-01-15").cast("date")
    for part in (cut, ~cut):
        _drop(f.telemetry.where(part), path, overwrite=False)
        job = stateful.stream_replay_buffer(state)
        ingest.run_available(_stream(f, path).writeStream.foreachBatch(job), checkpoint)
    return stateful.read_replay_buffer(f.spark, state)


def stream_quarantine(f: Fleet) -> DataFrame:
    """Good and bad raw vehicle lines split by a stream; rows and causes per side."""
    path, out, checkpoint = f.lake("vehicles"), scratch_path(f.spark, "out"), scratch_path(f.spark, "ckpt")
    checked = staging.vehicle_violations(ingest.stream_raw(f.spark, path, schemas.RAW_VEHICLES))
    ingest.stream_quarantine(checked, staging.vehicle_columns(), out, checkpoint)
    stored = f.spark.read.parquet(out)
    return stored.groupBy("quarantined").agg(
        F.count("*").alias("records"), F.count("raw").alias("with_text"), F.sum(F.size("violations")).alias("causes")
    ).withColumn("quarantined", F.col("quarantined").cast("boolean"))


_HARSH_BRAKE = sql("""SELECT event_id, vehicle_id, round(prev, 6) AS prev_speed_kph,
               coalesce(prev - speed_kph > greatest(8, prev * 0.25e0), FALSE) AS harsh_brake
        FROM (SELECT *, lag(speed_kph) OVER (PARTITION BY vehicle_id ORDER BY event_timestamp, event_id) AS prev FROM tel)""", "tel")

_STREAM_ALERTS = sql("""SELECT tel.vehicle_id AS entity_id, 'vehicle' AS entity_type, metric_name, round(v, 6) AS metric_value,
               CASE WHEN comparison_op = '>' AND v >= critical_threshold OR comparison_op = '<' AND v <= critical_threshold
                    THEN 'CRITICAL' ELSE 'WARNING' END AS severity, description, event_id, event_timestamp
        FROM (SELECT *, 'engine_temp_c' AS metric_name, engine_temp_c AS v FROM tel
              UNION ALL SELECT *, 'battery_voltage', battery_v FROM tel) tel
        JOIN veh ON veh.vehicle_id = tel.vehicle_id AND status = 'ACTIVE' JOIN thr USING (metric_name)
        WHERE comparison_op = '>' AND v >= warning_threshold OR comparison_op = '<' AND v <= warning_threshold""", "tel", "veh", "thr")


QUERIES = {
    "stream_dedup": (
        stream_dedup,
        sql("SELECT event_id, vehicle_id, event_timestamp, round(speed_kph, 6) AS speed_kph FROM tel", "tel"),
    ),
    "stream_vehicle_daily": (
        stream_vehicle_daily,
        sql("""SELECT vehicle_id, date_key, telemetry_events, round(avg_speed_kph, 6) AS avg_speed_kph, max_speed_kph,
                      round(avg_fuel_percent, 6) AS avg_fuel_percent, round(avg_engine_temp_c, 6) AS avg_engine_temp_c,
                      round(avg_battery_voltage, 6) AS avg_battery_voltage, speeding_events FROM vm""", "vm"),
    ),
    "stream_alerts": (stream_alerts, _STREAM_ALERTS),
    "stream_alerts_live": (stream_alerts_live, _STREAM_ALERTS),
    "stream_refresh": (stream_refresh, sql(f"SELECT {rounded(VEHICLE_MART)} FROM vm", "vm")),
    "stream_refresh_driver_mart": (stream_refresh_driver_mart, sql(f"SELECT {rounded(DRIVER_MART)} FROM dm", "dm")),
    "stream_harsh_brake": (stream_harsh_brake, _HARSH_BRAKE),
    "stream_harsh_brake_late": (stream_harsh_brake_late, _HARSH_BRAKE),
    "stream_replay_buffer": (
        stream_replay_buffer,
        sql("""SELECT vehicle_id, event_timestamp, event_id, round(speed_kph, 6) AS speed_kph
               FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM tel)
               WHERE rn <= 30""", "tel"),
    ),
    "stream_quarantine": (
        stream_quarantine,
        sql(f"""SELECT NOT ({_CLEAN_V}) AS quarantined, count(*) AS records, count(*) FILTER (WHERE NOT ({_CLEAN_V})) AS with_text,
                       CAST(sum(len(violations)) AS BIGINT) AS causes FROM coded GROUP BY 1""", "ev", rawv=_RAWV, coded=_CODES),
    ),
}
