import json

import pytest
from pyspark.errors import PySparkException

from checks import staging_queries
from checks.binding import Fleet
from roadbook import schemas
from roadbook.operators import conform, staging
from roadbook.sources.raw import parse_lines, read_raw, write_raw


def parsed(spark, schema, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return parse_lines(spark.createDataFrame(lines, "value string"), schema)


GOOD = {
    "event_id": "e1", "vehicle_id": "BUS_1", "driver_id": "DR_1", "timestamp": "2026-01-18T10:00:00Z",
    "lat": 6.1234567, "lon": 3.0,
}


def codes(df):
    return [sorted(r.violations) for r in df.select("violations").collect()]


def test_vehicle_limits_are_inclusive_and_nulls_allowed(spark):
    df = parsed(
        spark, schemas.RAW_VEHICLES,
        {**GOOD, "lat": 90, "lon": -180, "speed_kph": 0, "fuel_percent": 100},
        {**GOOD, "lat": -90, "lon": 180, "speed_kph": None, "fuel_percent": None},
        {**GOOD, "lat": 90.1, "lon": 180.1, "speed_kph": -0.1, "fuel_percent": 100.1},
    )
    assert codes(staging.vehicle_violations(df)) == [
        [], [], ["fuel_out_of_range", "lat_out_of_range", "lon_out_of_range", "speed_negative"],
    ]


def test_key_presence_is_not_null_check(spark):
    without = {k: v for k, v in GOOD.items() if k != "driver_id"}
    df = parsed(spark, schemas.RAW_VEHICLES, {**GOOD, "driver_id": None}, without, {**GOOD, "lat": None}, "{broken")
    found = codes(staging.vehicle_violations(df))
    assert found[0] == []
    assert found[1] == ["missing_driver_id"]
    assert found[2] == ["lat_out_of_range"]
    assert found[3] == sorted(f"missing_{k}" for k in staging.VEHICLE_KEYS)


def test_defaults_only_for_absent_keys(spark):
    df = parsed(spark, schemas.RAW_VEHICLES, GOOD, {**GOOD, "speeding": None}, {**GOOD, "speeding": True})
    rows = staging.stage_vehicles(df).collect()
    assert [r.speeding for r in rows] == [False, None, True]
    assert rows[0].lat == 6.123457
    assert rows[0].asDict().keys() == set(schemas.STAGED_VEHICLES.names)
    health = {"event_id": "h", "driver_id": "d", "timestamp": "2026-01-18T10:00:00Z"}
    df = parsed(spark, schemas.RAW_HEALTH, health, {**health, "alerts": None}, {**health, "alerts": ["x"]})
    assert [r.alerts for r in staging.stage_driver_health(df).collect()] == [[], None, ["x"]]


def test_health_and_finance_rules(spark):
    health = {"event_id": "h", "driver_id": "d", "timestamp": "2026-01-18T10:00:00Z"}
    df = parsed(
        spark, schemas.RAW_HEALTH,
        {**health, "fatigue_index": 1, "shift_hours": 0},
        {**health, "fatigue_index": 1.01, "shift_hours": -1, "continuous_driving_hours": -1},
    )
    assert codes(staging.health_violations(df)) == [
        [], ["continuous_hours_negative", "fatigue_out_of_range", "shift_hours_negative"],
    ]
    day = {"event_id": "f", "driver_id": "d", "date": "2026-01-20", "total_revenue": 1, "total_cost": 1, "net_profit": 0}
    short = {k: v for k, v in day.items() if k != "net_profit"}
    df = parsed(spark, schemas.RAW_FINANCE, day, {**day, "total_revenue": -1, "total_cost": None}, short)
    assert codes(staging.finance_violations(df)) == [
        [], ["cost_negative", "revenue_negative"], ["missing_net_profit"],
    ]


def test_strict_stops_and_quarantine_splits(spark):
    df = staging.vehicle_violations(parsed(spark, schemas.RAW_VEHICLES, GOOD, {**GOOD, "lat": 91}))
    with pytest.raises(PySparkException, match="lat_out_of_range"):
        staging.stage_vehicles(staging.enforce(df, "strict")).collect()
    good, bad = staging.enforce(df, "quarantine")
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(ValueError):
        staging.enforce(df, "other")


def test_trips_keep_their_own_keys(spark):
    trip = {"event_id": "t1", "driver_id": "d", "timestamp": "2026-01-20T01:00:00Z", "revenue": 5.0, "total_cost": 1.0}
    record = {
        "event_id": "f", "driver_id": "d", "date": "2026-01-20", "total_revenue": 5, "total_cost": 1,
        "net_profit": 4, "trips": [trip, {**trip, "event_id": "t2", "fraud_alert": None, "revenue": -1}],
    }
    days = parsed(spark, schemas.RAW_FINANCE, record, {**record, "trips": []}, {k: v for k, v in record.items() if k != "trips"})
    trips = staging.trip_violations(staging.explode_trips(days))
    assert codes(trips) == [[], ["revenue_negative"]]
    rows = staging.stage_finance_trips(trips).collect()
    assert [(r.trip_event_id, r.daily_event_id, r.fraud_alert) for r in rows] == [("t1", "f", False), ("t2", "f", None)]


def test_raw_round_trip_keeps_lineage_and_nulls(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = spark.createDataFrame([("h1", "d", "t", 1.0)], "event_id string, driver_id string, timestamp string, shift_hours double")
    write_raw(conform.align(df, schemas.RAW_HEALTH), path)
    write_raw(conform.align(df, schemas.RAW_HEALTH), path)
    rows = read_raw(spark, path, schemas.RAW_HEALTH).collect()
    assert len(rows) == 2 and rows[0].source_file.startswith("file:")
    assert "alerts" in rows[0].present_keys
    write_raw(conform.align(df, schemas.RAW_HEALTH), path, overwrite=True)
    assert read_raw(spark, path, schemas.RAW_HEALTH).count() == 1
    (tmp_path / "empty").mkdir()
    for missing in ("nothing", "empty", "*.jsonl"):
        with pytest.raises(FileNotFoundError):
            read_raw(spark, str(tmp_path / missing), schemas.RAW_HEALTH)


def test_to_fact_uses_utc(spark):
    df = spark.createDataFrame([("2026-01-18T23:30:00-02:00",), ("2026-01-18T23:30:00Z",)], "timestamp string")
    rows = conform.to_fact(df).collect()
    assert [str(r.date_key) for r in rows] == ["2026-01-19", "2026-01-18"]


def test_align_and_ensure_columns(spark):
    df = spark.createDataFrame([(1, "x")], "extra int, driver_id string")
    assert conform.align(df, schemas.DIM_DRIVER).schema.names == schemas.DIM_DRIVER.names
    assert conform.ensure_columns(df, schemas.DIM_DRIVER).columns == [
        "extra", "driver_id", "status", "first_seen_at", "last_seen_at",
    ]


def test_lines_are_parsed_once_and_misfits_named(spark):
    full = {
        "event_id": "h", "driver_id": "d", "timestamp": "t", "shift_hours": 1.0, "continuous_driving_hours": 1.0,
        "fatigue_index": 0.5, "breaks_taken": True, "alerts": [],
    }
    names = schemas.RAW_HEALTH.names
    lines = {
        json.dumps(full): (names, []),
        json.dumps({**full, "unknown": 1}): (names, []),
        json.dumps({**full, "alerts": None}): (names, []),
        json.dumps({"unknown": 1, "alerts": None}): (["alerts"], []),
        json.dumps({**full, "shift_hours": "1", "breaks_taken": 1, "alerts": "x"}): (names, ["shift_hours", "breaks_taken", "alerts"]),
        json.dumps({**full, "driver_id": 7}): (names, []),
        "{}": ([], []), "{broken": (None, []), "[1]": (None, []), "": (None, []), "null": (None, []),
    }
    df = parsed(spark, schemas.RAW_HEALTH, *lines)
    found = df.select("value", "present_keys", "bad_types").collect()
    assert {r.value: (r.present_keys, r.bad_types) for r in found} == lines
    # one parse of every line, and one behind a condition
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 and "THEN from_json" in plan


def test_both_sides_of_a_split_come_from_one_parse(spark, sf_dir):
    plan = staging_queries.quarantine(Fleet(spark, sf_dir))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan text") == 3
