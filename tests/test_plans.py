"""End-to-end runs on a small lake, streams, and the shape of physical plans."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.binding import Fleet
from roadbook import schemas
from roadbook.operators import alerts, marts, upserts
from roadbook.operators.conform import align
from roadbook.plans import daily, staging, warehouse
from roadbook.sources import tables
from roadbook.streaming import live, stateful

AT = dt.datetime(2026, 2, 9, 6)


def write(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def day_records(day):
    stamp = f"2026-02-{day:02d}T10:00:00Z"
    vehicle = {"vehicle_id": "BUS_1", "driver_id": "DR_1", "timestamp": stamp, "lat": 6.4, "lon": 3.3,
               "speed_kph": 70.0, "engine_temp_c": 95.0, "battery_v": 12.0, "fuel_percent": 50.0, "speeding": True}
    trip = {"event_id": f"trip{day}", "driver_id": "DR_1", "timestamp": stamp, "revenue": 30.0, "total_cost": 10.0}
    return {
        "vehicles": [{**vehicle, "event_id": f"evt{day}-{i}"} for i in range(3)],
        "driver_health": [{"event_id": f"h{day}", "driver_id": "DR_1", "timestamp": stamp, "shift_hours": 8.0,
                           "continuous_driving_hours": 4.0, "fatigue_index": 0.9, "alerts": ["fatigue_risk"]}],
        "finance": [{"event_id": f"f{day}", "driver_id": "DR_1", "date": f"2026-02-{day:02d}", "total_revenue": 30.0, "total_cost": 10.0,
                     "net_profit": 20.0, "fraud_alerts_count": 1, "trips": [trip]}],
    }


def drop(lake, day):
    for domain, records in day_records(day).items():
        write(lake / domain / f"2026-02-{day:02d}.jsonl", records)


@pytest.fixture
def masters(spark):
    return (
        spark.createDataFrame([("DR_1", "ACTIVE"), ("DR_2", "RETIRED")], "driver_id string, status string"),
        spark.createDataFrame([("BUS_1", "ACTIVE"), ("CAR_1", "MAINTENANCE")], "vehicle_id string, status string"),
    )


def test_daily_run_is_idempotent_and_takes_late_files(spark, tmp_path, masters):
    lake, out, root = tmp_path / "lake", str(tmp_path / "staged"), str(tmp_path / "wh")
    drop(lake, 8)
    found = daily.run_day(spark, str(lake), out, root, *masters, AT)
    assert {r.alert_name for r in found.collect()} == {"driver_fatigue", "vehicle_risk", "fraud"}

    def state():
        return {
            n: sorted(map(repr, map(tuple, tables.read_table(spark, root, n).collect())))
            for n in ("fact_vehicle_telemetry", "fact_driver_daily_metrics", "fact_vehicle_daily_metrics")
        }

    def files(day=""):
        return sorted(str(p) for n in ("fact_*",) for t in (tmp_path / "wh").glob(n) for p in t.rglob("*.parquet") if day in str(p))

    before, stored = state(), files()
    daily.run_day(spark, str(lake), out, root, *masters, AT)
    assert state() == before and files() == stored  # an unchanged rerun writes no fact and no mart
    drop(lake, 5)  # late file of an older day
    daily.run_day(spark, str(lake), out, root, *masters, AT)
    assert files("date_key=2026-02-08") == stored
    mart = tables.read_table(spark, root, "fact_driver_daily_metrics")
    assert sorted(str(r.date_key) for r in mart.collect()) == ["2026-02-05", "2026-02-08"]
    assert mart.first().fatigue_alert is True
    dim = {r.vehicle_id: r for r in tables.read_current(spark, root, "dim_vehicle").collect()}
    assert dim["CAR_1"].last_seen_at is None and dim["BUS_1"].first_seen_at == dt.datetime(2026, 2, 5, 10)
    assert tables.read_table(spark, root, "alerts").count() == 3  # one evaluation time, however often it is run
    assert daily.run_alerts(spark, root, AT + dt.timedelta(days=1)).count() == 3
    assert tables.read_table(spark, root, "alerts").count() == 6
    assert staging.read_good(spark, out, "finance_trips").count() == 2
    checks = daily.run_checks(spark, root, dt.date(2026, 2, 9))
    assert checks["nulls"].first().bad_rows == 0 and checks["freshness"].first().status == "FRESH"


def test_high_watermark_plan_ignores_late_files(spark, tmp_path, masters):
    lake, out, root = tmp_path / "lake", str(tmp_path / "staged"), str(tmp_path / "wh")
    drop(lake, 8)
    daily.run_day(spark, str(lake), out, root, *masters, AT, policy="high_watermark")
    drop(lake, 5)
    drop(lake, 9)
    daily.run_day(spark, str(lake), out, root, *masters, AT, policy="high_watermark")
    days = {str(r.date_key) for r in tables.read_table(spark, root, "fact_vehicle_daily_metrics").collect()}
    assert days == {"2026-02-08", "2026-02-09"}
    # what was passed over stays noted, and a later run by keys makes up for it
    assert [str(r.date_key) for r in warehouse.pending(spark, root, "fact_daily_finance").collect()] == ["2026-02-05"]
    daily.run_day(spark, str(lake), out, root, *masters, AT)
    mart = tables.read_table(spark, root, "fact_driver_daily_metrics")
    assert {str(r.date_key) for r in mart.collect()} == {"2026-02-05", "2026-02-08", "2026-02-09"}
    assert warehouse.pending(spark, root, "fact_daily_finance").count() == 0


def test_strict_stops_quarantine_goes_on(spark, tmp_path):
    lake, out = tmp_path / "lake", str(tmp_path / "staged")
    good = day_records(8)["vehicles"]
    write(lake / "vehicles" / "a.jsonl", [*good, {**good[0], "lat": 99}, "{broken"])
    with pytest.raises(PySparkException):
        staging.stage(spark, "vehicles", str(lake), out)
    staging.stage(spark, "vehicles", str(lake), out, "quarantine")
    assert staging.read_good(spark, out, "vehicles").count() == 3
    bad = {r.raw: r.violations for r in staging.read_quarantined(spark, out, "vehicles").collect()}
    assert bad["{broken"] and ["lat_out_of_range"] in bad.values()
    write(lake / "vehicles" / "a.jsonl", good)
    staging.stage(spark, "vehicles", str(lake), out, "quarantine")
    assert staging.read_quarantined(spark, out, "vehicles").count() == 0


def test_wrong_types_times_and_null_ids_are_refused(spark, tmp_path, masters):
    lake, out, root = tmp_path / "lake", str(tmp_path / "staged"), str(tmp_path / "wh")
    drop(lake, 8)
    good = day_records(9)
    vehicle, health, day = good["vehicles"][0], good["driver_health"][0], good["finance"][0]
    write(lake / "vehicles" / "bad.jsonl", [
        {**vehicle, "speed_kph": "fast"}, {**vehicle, "speed_kph": True}, {**vehicle, "timestamp": "not a time"},
        {**vehicle, "event_id": None}, {**vehicle, "event_id": "fine", "speed_kph": None},
    ])
    write(lake / "driver_health" / "bad.jsonl", [{**health, "alerts": "x"}, {**health, "driver_id": None}, {**health, "shift_hours": -1}])
    write(lake / "finance" / "bad.jsonl", [
        {**day, "trips": "oops"}, {**day, "date": "soon"}, {**day, "total_revenue": -1.0},
        {**day, "event_id": "fine", "fraud_alerts_count": 2.0, "trips": [{**day["trips"][0], "revenue": "x"}, {**day["trips"][0], "total_cost": -2}]},
    ])
    with pytest.raises(PySparkException):
        daily.run_day(spark, str(lake), out, root, *masters, AT)
    daily.run_day(spark, str(lake), out, root, *masters, AT, mode="quarantine")
    causes = {d: sorted(tuple(r.violations) for r in staging.read_quarantined(spark, out, d).collect()) for d in (*daily.LOADS, "finance_trips")}
    assert causes == {
        "vehicles": [("bad_time",), ("bad_type_speed_kph",), ("bad_type_speed_kph",), ("null_event_id",)],
        "driver_health": [("bad_type_alerts",), ("null_driver_id",), ("shift_hours_negative",)],
        "finance": [("bad_time",), ("bad_type_trips",), ("revenue_negative",)],
        "finance_trips": [("bad_type_revenue",), ("cost_negative",)],
    }
    counts = {r.event_id: r.fraud_alerts_count for r in tables.read_table(spark, root, "fact_daily_finance").collect()}
    assert counts == {"f8": 1, "fine": 2}
    assert tables.read_table(spark, root, "fact_vehicle_telemetry").count() == 4


def test_a_bad_trip_publishes_no_day(spark, tmp_path):
    lake, out = tmp_path / "lake", str(tmp_path / "staged")
    day = day_records(8)["finance"][0]
    write(lake / "finance" / "a.jsonl", [{**day, "trips": [{**day["trips"][0], "revenue": -1}]}])
    with pytest.raises(PySparkException):
        staging.stage(spark, "finance", str(lake), out)
    assert staging.read_good(spark, out, "finance").count() == 0 and staging.staged_files(spark, out, "finance") == []


def test_keys_of_another_fact_are_not_lost(spark, tmp_path, masters):
    """A run loads a finance day and dies; then a micro-batch of telemetry comes, then one of shifts."""
    root = str(tmp_path)
    from roadbook.sources.reference import default_thresholds

    warehouse.seed_thresholds(spark, root, default_thresholds(spark))
    warehouse.build_dimensions(spark, root, *masters)
    row = ("f1", "DR_1", dt.date(2026, 2, 3), 10.0, 4.0, 6.0, 0, "hold", 0.0)
    warehouse.load_fact(spark, root, "fact_daily_finance", spark.createDataFrame([row], schemas.FACT_DAILY_FINANCE))
    stateful.stream_refresh(root)(samples(spark, ("a", "v", 1, 60.0)).withColumn("driver_id", F.lit("DR_1")), 0)
    shift = ("s1", "DR_1", dt.datetime(2026, 2, 4, 8), 9.0, 9.0, 0.8, True, ["x"], dt.date(2026, 2, 4))
    stateful.stream_refresh(root, "fact_driver_shifts")(spark.createDataFrame([shift], schemas.FACT_DRIVER_SHIFTS), 0)
    mart = {str(r.date_key): r for r in tables.read_table(spark, root, "fact_driver_daily_metrics").collect()}
    assert sorted(mart) == ["2026-02-03", "2026-02-04", "2026-02-08"]
    assert mart["2026-02-03"].net_profit == 6.0
    assert not any(warehouse.pending_loads(spark, root, n) for n in warehouse.IDENTITY)


def test_calendar_reaches_as_far_as_the_facts(spark, tmp_path, masters):
    root = str(tmp_path)
    row = ("f1", "DR_1", dt.date(2029, 5, 3), 10.0, 4.0, 6.0, 0, "hold", 0.0)
    warehouse.load_fact(spark, root, "fact_daily_finance", spark.createDataFrame([row], schemas.FACT_DAILY_FINANCE))
    warehouse.build_dimensions(spark, root, *masters)
    assert tables.read_current(spark, root, "dim_date").agg(F.max("date_key")).first()[0] == dt.date(2029, 5, 3)


def test_dimensions_read_no_fact(spark, tmp_path, masters):
    root = str(tmp_path)
    shifts = [(f"s{d}", "DR_1", dt.datetime(2026, 2, d, 8), 9.0, 9.0, 0.8, True, ["x"], dt.date(2026, 2, d)) for d in (3, 5)]
    warehouse.load_fact(spark, root, "fact_driver_shifts", spark.createDataFrame(shifts, schemas.FACT_DRIVER_SHIFTS))
    warehouse.build_dimensions(spark, root, *masters)
    dim = {r.driver_id: (r.first_seen_at, r.last_seen_at) for r in tables.read_current(spark, root, "dim_driver").collect()}
    assert dim == {"DR_1": (dt.datetime(2026, 2, 3, 8), dt.datetime(2026, 2, 5, 8)), "DR_2": (None, None)}
    assert "fact_driver_shifts/date_key" not in plan(warehouse.activity(spark, root, "fact_driver_shifts"))
    # a shift that moves to another day is no longer seen on the old one
    warehouse.load_fact(spark, root, "fact_driver_shifts", spark.createDataFrame([
        ("s5", "DR_1", dt.datetime(2026, 2, 4, 8), 9.0, 9.0, 0.8, True, ["x"], dt.date(2026, 2, 4))], schemas.FACT_DRIVER_SHIFTS))
    warehouse.build_dimensions(spark, root, *masters)
    seen = sorted({r.event_timestamp.day for r in warehouse.activity(spark, root, "fact_driver_shifts").collect()})
    assert seen == [3, 4]


def test_harsh_brake_plan(spark):
    text = plan(alerts.harsh_brake(samples(spark, ("a", "v", 1, 1.0))))
    assert "hint" not in text.lower()
    for block in re.findall(r"\(\d+\) Window\n.*?\n\n", text, re.S):
        assert re.search(r"\[vehicle_id#\d+, (slot|day)#\d+\]", block), block


def samples(spark, *rows):
    full = [(e, v, "d", dt.datetime(2026, 2, 8, 10, m), 0.0, 0.0, s, None, 90.0, 12.0, False, dt.date(2026, 2, 8)) for e, v, m, s in rows]
    return spark.createDataFrame(full, schemas.FACT_VEHICLE_TELEMETRY)


def verdicts(spark, out):
    return {r.event_id: (r.prev_speed_kph, r.harsh_brake) for r in stateful.read_harsh_brake(spark, out).collect()}


def test_harsh_brake_batches_judge_late_rows_and_replay(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = stateful.stream_harsh_brake(out, state, "4 minutes")
    job(samples(spark, ("a", "v", 1, 80.0), ("b", "v", 5, 70.0)), 0)
    second = samples(spark, ("c", "v", 6, 20.0), ("late", "v", 3, 90.0), ("x", "w", 1, 5.0))
    job(second, 1)
    job(second, 1)  # the batch runs again after a failure
    want = {"a": (None, False), "late": (80.0, False), "b": (90.0, False), "c": (70.0, True), "x": (None, False)}
    assert verdicts(spark, out) == want
    # b has its first and its new verdict
    assert tables.read_versions(spark, out, stateful.VERDICT).count() == 6
    # the vehicle is open from minute 2: minute 1 is too late, a repeat of a kept or of an older sample changes nothing
    job(samples(spark, ("older", "v", 1, 10.0), ("a", "v", 1, 80.0), ("c", "v", 6, 20.0), ("d", "v", 2, 60.0)), 2)
    want |= {"older": (None, None), "d": (80.0, False), "late": (60.0, False)}
    assert verdicts(spark, out) == want


def test_harsh_brake_in_any_order_is_the_batch_result(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"e{i}", f"v{rng.randrange(3)}", rng.randrange(60), float(rng.randrange(100))) for i in range(120)]
    whole = alerts.harsh_brake(samples(spark, *rows)).collect()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = stateful.stream_harsh_brake(out, state, "1 hour")
    for i in range(4):
        job(samples(spark, *rows[i * 30 : i * 30 + 30]), i)
    assert verdicts(spark, out) == {r.event_id: (r.prev_speed_kph, r.harsh_brake) for r in whole}


def test_harsh_brake_batches_join_once_and_leave_no_copies(spark, tmp_path, monkeypatch):
    seen, whole, shared = [], alerts.harsh_brake, str(tmp_path / "shared")
    monkeypatch.setattr(alerts, "harsh_brake", lambda tel: seen.append(plan(tel)) or whole(tel))
    monkeypatch.setattr(stateful, "scratch_path", lambda _, label: f"{shared}/{label}")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = stateful.stream_harsh_brake(out, state, "1 hour")
    for i in range(2):
        job(samples(spark, (f"a{i}", "v", i, 80.0), (f"b{i}", "w", i, 70.0)), i)
    assert len(seen) == 2 and not any(word in text for text in seen for word in ("Join", "Exchange", "InMemoryTableScan"))
    assert not any(path.is_dir() for path in (tmp_path / "shared").glob("*"))


def test_batches_write_the_buckets_of_their_vehicles_only(spark, tmp_path):
    state = tmp_path / "state"
    job = stateful.stream_replay_buffer(str(state), n=2)
    job(samples(spark, *[(f"e{i}", f"v{i}", 1, 1.0) for i in range(200)]), 0)
    for i in range(1, 5):
        job(samples(spark, (f"n{i}", "v7", i + 1, 1.0)), i)
    held = {p.parent.name: len(list(p.parent.glob("bucket=*"))) for p in state.glob("version=*/bucket=*")}
    assert held["version=1"] > 50 and held["version=4"] == held["version=5"] == 1 and len(held) == 3
    got = {r.event_id for r in stateful.read_replay_buffer(spark, str(state)).collect()}
    assert got == {f"e{i}" for i in range(200) if i != 7} | {"n3", "n4"}


def test_replay_buffer_state(spark, tmp_path):
    state = str(tmp_path / "state")
    job = stateful.stream_replay_buffer(state, n=2)
    job(samples(spark, ("a", "v", 1, 1.0), ("b", "v", 2, 1.0)), 0)
    job(samples(spark, ("c", "v", 3, 1.0)), 1)
    job(samples(spark, ("c", "v", 3, 1.0)), 1)
    assert {r.event_id for r in stateful.read_replay_buffer(spark, state).collect()} == {"b", "c"}


def test_stream_refresh_in_any_day_order(spark, tmp_path):
    root = str(tmp_path)
    from roadbook.sources.reference import default_thresholds

    warehouse.seed_thresholds(spark, root, default_thresholds(spark))
    job = stateful.stream_refresh(root)
    late = samples(spark, ("z", "v", 1, 30.0)).withColumn("date_key", F.lit(dt.date(2026, 2, 1)))
    for i, batch in enumerate([samples(spark, ("a", "v", 1, 60.0)), late, samples(spark, ("a", "v", 1, 60.0), ("b", "v", 2, 20.0))]):
        job(batch, i)
    rows = {str(r.date_key): (r.telemetry_events, r.avg_speed_kph) for r in tables.read_table(spark, root, "fact_vehicle_daily_metrics").collect()}
    assert rows == {"2026-02-08": (2, 40.0), "2026-02-01": (1, 30.0)}


def test_stream_refresh_survives_a_crash_before_the_mart(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    from roadbook.sources.reference import default_thresholds

    warehouse.seed_thresholds(spark, root, default_thresholds(spark))
    job, batch = stateful.stream_refresh(root), samples(spark, ("a", "v", 1, 60.0))
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "refresh_vehicle_mart", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job(batch, 0)
    assert tables.read_table(spark, root, "fact_vehicle_daily_metrics").count() == 0
    job(batch, 0)
    assert tables.read_table(spark, root, "fact_vehicle_daily_metrics").count() == 1
    assert tables.read_table(spark, root, "fact_vehicle_telemetry").count() == 1


# plan shapes -------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_driver_mart_shuffles_once(spark, sf_dir):
    text = plan(Fleet(spark, sf_dir).driver_mart)
    assert len(re.findall(r"Exchange\s*\n?Arguments: hashpartitioning|\(\d+\) Exchange", text)) == 1
    assert "SortAggregate" not in text


def test_rank_filters_run_before_the_shuffle(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    for df in (upserts.dedup(f.telemetry, ["event_id"], ["event_timestamp"]), alerts.replay_buffer(f.telemetry)):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    text = plan(marts.shift_agg(Fleet(spark, sf_dir).shifts))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<event_id" not in text


def test_high_water_prunes_partitions(spark, tmp_path):
    rows = [(f"e{i}", "a", dt.date(2026, 2, 1 + i), 1.0, 1.0, 0.0, 0, "hold", 0.0) for i in range(5)]
    path = str(tmp_path / "fact_daily_finance")
    tables.write_fact(spark.createDataFrame(rows, schemas.FACT_DAILY_FINANCE), path)
    fact = tables.read_table(spark, str(tmp_path), "fact_daily_finance")
    text = plan(marts.after_mark(fact, F.lit(dt.date(2026, 2, 3))))
    assert "PartitionFilters: [isnotnull(date_key" in text


@pytest.mark.parametrize("key", [k for k in entry.queries() if not k.startswith("stream_") and "roundtrip" not in k])
def test_no_cross_joins_or_global_windows(spark, sf_dir, key):
    text = plan(entry.queries()[key](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for block in re.findall(r"\(\d+\) Window\n.*?\n\n", text, re.S):
        # functions, partition keys and order: a window without keys has two lists only
        assert block.count("], [") >= 2, block
    assert "BatchEvalPython" not in text


def test_batches_align_by_name(spark):
    assert align(samples(spark, ("a", "v", 1, 1.0)), schemas.FACT_VEHICLE_TELEMETRY).count() == 1


def test_files_in_folders_are_staged_once(spark, tmp_path):
    """Files of one name in several folders are files of their own, and names with blanks and signs are told apart."""
    lake, out = tmp_path / "a lake+1", str(tmp_path / "staged")
    for day, folder in ((1, "date=2026-02-01"), (2, "date=2026-02-02/late"), (3, "."), (4, "x y+z%41")):
        write(lake / "vehicles" / folder / "drop.jsonl", day_records(day)["vehicles"])
    write(lake / "vehicles" / "_hidden" / "drop.jsonl", day_records(9)["vehicles"])
    assert len(staging.stage(spark, "vehicles", str(lake), out)) == 4
    staged = staging.read_good(spark, out, "vehicles")
    wanted = sorted(f"evt{day}-{i}" for day in range(1, 5) for i in range(3))
    assert sorted(r.event_id for r in staged.collect()) == wanted
    assert staging.stage(spark, "vehicles", str(lake), out) == []
    # a changed file replaces its own rows only
    write(lake / "vehicles" / "date=2026-02-01" / "drop.jsonl", day_records(1)["vehicles"][:1])
    assert len(staging.stage(spark, "vehicles", str(lake), out)) == 1
    left = sorted(r.event_id for r in staging.read_good(spark, out, "vehicles").collect())
    assert left == [e for e in wanted if e not in ("evt1-1", "evt1-2")]


def test_live_alerts_follow_the_limits(spark, tmp_path):
    """A limit that changes between two batches of a running job holds from the next batch on."""
    root, out = str(tmp_path / "wh"), str(tmp_path / "alerts")
    tables.replace_table(
        align(spark.createDataFrame([("BUS_1", "ACTIVE")], "vehicle_id string, status string"), schemas.DIM_VEHICLE),
        tables.table_path(root, "dim_vehicle"),
    )
    samples = spark.createDataFrame(
        [("e1", "BUS_1", dt.datetime(2026, 2, 1), 100.0, 13.0)],
        "event_id string, vehicle_id string, event_timestamp timestamp, engine_temp_c double, battery_v double",
    )

    def limit(warning, critical):
        rules = [("engine_temp_c", warning, critical, ">", "hot", True)]
        frame = spark.createDataFrame(
            rules, "metric_name string, warning_threshold double, critical_threshold double, comparison_op string, description string, is_active boolean"
        )
        warehouse.seed_thresholds(spark, root, align(frame, schemas.ALERT_THRESHOLDS))

    job = live.keep_alerts(root, out)
    for batch, (warning, critical) in enumerate([(110.0, 120.0), (95.0, 120.0), (80.0, 90.0)]):
        limit(warning, critical)
        job(samples, batch)
    job(samples, 2)  # a repeated batch
    found = [
        [r.severity for r in tables.read_versions(spark, out, "severity string").collect()],
        sorted(r.severity for r in spark.read.parquet(f"{out}/version=2").collect()),
    ]
    assert sorted(found[0]) == ["CRITICAL", "WARNING"] and found[1] == ["WARNING"]


def test_alerts_of_stored_marts_read_the_newest_day_by_name(spark, tmp_path, masters):
    lake, out, root = tmp_path / "lake", str(tmp_path / "staged"), str(tmp_path / "wh")
    for day in (6, 7, 8):
        drop(lake, day)
    daily.run_day(spark, str(lake), out, root, *masters, AT)
    names = ["fact_driver_daily_metrics", "fact_vehicle_daily_metrics"]
    days = [tables.newest_day(spark, root, n) for n in names]
    assert days == [dt.date(2026, 2, 8)] * 2 and tables.newest_day(spark, root, "fact_daily_nothing") is None
    marts_ = [tables.read_table(spark, root, n) for n in names]
    fixed = [tables.read_current(spark, root, n) for n in ("dim_driver", "alert_thresholds")]
    plain, named = alerts.all_alerts(*marts_, *fixed, AT), alerts.all_alerts(*marts_, *fixed, AT, *days)
    assert sorted(map(str, plain.collect())) == sorted(map(str, named.collect())) != []

    def scans(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return len(re.findall(r"Relation [^\n]*avg_(?:fatigue_index|engine_temp_c)", plan))

    # fatigue, fraud and vehicles read the newest day, the lag of the drivers reads all
    assert scans(named) == 4 < scans(plain)
    # an evaluation before anything is stored finds nothing
    assert daily.run_alerts(spark, str(tmp_path / "empty"), AT).count() == 0
