import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadbook import schemas
from roadbook.functions import text
from roadbook.operators import alerts, quality
from roadbook.operators.conform import align
from roadbook.operators.reports import drivers, generic, overview, vehicles
from roadbook.sources.reference import default_thresholds

DAY = dt.date(2026, 2, 8)
START = dt.datetime(2026, 2, 8)


def driver_mart(spark, *rows):
    """(driver, day, fatigue, continuous, speeding, fraud, profit)"""
    full = [(d, day, 5, 50.0, sp, 8.0, c, f, 1, 10.0, 1.0, p, fr, None, None, None) for d, day, f, c, sp, fr, p in rows]
    return spark.createDataFrame(full, schemas.FACT_DRIVER_DAILY_METRICS)


def vehicle_mart(spark, *rows):
    """(vehicle, day, temp, rate, speeding, volts)"""
    full = [(v, day, 10, 50.0, 90.0, 50.0, t, b, sp, r, None, None, None) for v, day, t, r, sp, b in rows]
    return spark.createDataFrame(full, schemas.FACT_VEHICLE_DAILY_METRICS)


def dim(spark, **status):
    return spark.createDataFrame([(k, v, None, None) for k, v in status.items()], schemas.DIM_DRIVER)


def test_fatigue_is_inclusive_and_active_only(spark):
    mart = driver_mart(
        spark, ("a", DAY, 0.6, 0.0, 0, 0, 0.0), ("b", DAY, 0.59, 0.0, 0, 0, 0.0), ("r", DAY, 0.9, 0.0, 0, 0, 0.0),
        ("c", DAY, 0.8, 0.0, 0, 0, 0.0), ("a", DAY - dt.timedelta(days=1), 0.99, 0.0, 0, 0, 0.0),
    )
    got = alerts.alert_fatigue(mart, dim(spark, a="ACTIVE", b="ACTIVE", c="ACTIVE", r="RETIRED"), default_thresholds(spark))
    assert {(r.entity_id, r.severity) for r in got.collect()} == {("a", "WARNING"), ("c", "CRITICAL")}


def test_vehicle_risk_limits(spark):
    mart = vehicle_mart(spark, ("v", DAY, 90.0, 0.0, 0, 12.0), ("w", DAY, 120.0, 0.0, 0, 12.0), ("x", DAY, 89.9, 0.2, 0, 12.0))
    got = {r.entity_id: r.severity for r in alerts.alert_vehicle_risk(mart, default_thresholds(spark)).collect()}
    assert got == {"v": "WARNING", "w": "CRITICAL"}
    static = {r.entity_id: r.severity for r in alerts.alert_vehicle_static(mart).collect()}
    assert static == {"w": "CRITICAL", "x": "WARNING"}


def test_freshness_and_no_activity(spark):
    late = driver_mart(spark, ("a", DAY - dt.timedelta(days=2), 0.1, 0.0, 0, 0, 0.0), ("r", DAY, 0.1, 0.0, 0, 0, 0.0))
    people = dim(spark, a="ACTIVE", r="RETIRED")
    assert [r.metric_value for r in alerts.alert_freshness(late, people).collect()] == [2.0]
    assert alerts.alert_freshness(late, people, max_lag=2).count() == 0
    empty = spark.createDataFrame([], schemas.FACT_DRIVER_DAILY_METRICS)
    assert alerts.alert_freshness(empty, people).count() == 0
    assert alerts.alert_no_activity(empty).count() == 1
    assert alerts.alert_no_activity(late).count() == 0


def test_table_driven_rules(spark):
    long = spark.createDataFrame(
        [("v", DAY, "battery_voltage", 11.8, "vehicle"), ("v", DAY, "battery_voltage", 11.1, "vehicle"),
         ("v", DAY, "engine_temp_c", 121.0, "vehicle"), ("v", DAY, "unknown", 1.0, "vehicle"), ("v", DAY, "engine_temp_c", None, "vehicle")],
        "entity_id string, date_key date, metric_name string, metric_value double, entity_type string",
    )
    rules = default_thresholds(spark)
    assert sorted((r.metric_value, r.severity) for r in alerts.evaluate_thresholds(long, rules).collect()) == [
        (11.1, "CRITICAL"), (121.0, "CRITICAL"),
    ]
    assert alerts.evaluate_thresholds(long, rules, inclusive=True).count() == 3
    off = rules.withColumn("is_active", F.col("metric_name") != "engine_temp_c")
    assert alerts.evaluate_thresholds(long, off).count() == 1


def test_digest_counts_all_shows_five(spark):
    rows = [("fraud", f"d{i}", "driver", "fraud_alerts", float(i), "CRITICAL" if i % 2 else "WARNING", START, "x") for i in range(6)]
    rows.append(("lag", "SYSTEM", "system", "days", 2.0, "WARNING", START, "y"))
    got = {r.alert_name: r for r in alerts.alert_digest(spark.createDataFrame(rows, schemas.ALERTS)).collect()}
    assert got["fraud"].total == 6
    assert got["fraud"].note == "Showing 5 of 6. See dashboard for full details."
    assert [line.split(" | ")[1] for line in got["fraud"].body.split("\n")] == [f"Entity: d{i}" for i in (5, 3, 1, 4, 2)]
    assert got["lag"].note is None and got["lag"].headline == "1 alert(s) detected"


def samples(spark, rows):
    full = [(e, v, "d", ts, 0.0, 0.0, s, None, None, None, False, ts.date()) for e, v, ts, s in rows]
    return spark.createDataFrame(full, schemas.FACT_VEHICLE_TELEMETRY)


def brute_force(rows):
    out, last = {}, {}
    for e, v, ts, s in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        prev = last.get(v)
        out[e] = prev is not None and s is not None and prev - s > max(8.0, prev * 0.25)
        last[v] = s
    return out


def test_harsh_brake_matches_brute_force_on_a_hot_vehicle(spark):
    """One vehicle owns most samples; gaps, slot borders, equal times and null speeds occur."""
    rnd = random.Random(7)
    rows = []
    for i in range(1500):
        vehicle = "HOT" if rnd.random() < 0.7 else f"v{rnd.randrange(5)}"
        ts = START + dt.timedelta(minutes=rnd.choice([0, 1, 59, 60, 61, 119]) + 60 * rnd.randrange(40))
        rows.append((f"e{i:05d}", vehicle, ts, None if rnd.random() < 0.05 else float(rnd.randrange(0, 120))))
    got = {r.event_id: r.harsh_brake for r in alerts.harsh_brake(samples(spark, rows)).collect()}
    assert got == brute_force(rows)


def test_harsh_brake_limit(spark):
    rows = [(f"e{i}", "v", START + dt.timedelta(minutes=i), s) for i, s in enumerate([40.0, 30.0, 22.0, 13.9, 100.0, 75.0, 50.0])]
    got = {r.event_id: r.harsh_brake for r in alerts.harsh_brake(samples(spark, rows)).collect()}
    # more than max(8, a quarter): 40->30 is not (10), 30->22 is not (8), 22->13.9 is, 100->75 is not (25), 75->50 is
    assert [got[f"e{i}"] for i in range(7)] == [False, False, False, True, False, False, True]


def test_replay_and_signals(spark):
    rows = [(f"e{i:02d}", "v", START + dt.timedelta(minutes=i), float(i)) for i in range(40)]
    kept = alerts.replay_buffer(samples(spark, rows)).collect()
    assert {r.event_id for r in kept} == {f"e{i:02d}" for i in range(10, 40)}
    df = spark.createDataFrame([(0.59,), (0.6,), (None,)], "fatigue_index double")
    assert [(r.breaks_taken, r.alerts) for r in alerts.shift_signals(df).collect()] == [
        (True, []), (False, ["fatigue_risk"]), (None, []),
    ]
    speeds = spark.createDataFrame([(50.0,), (50.1,)], "speed_kph double")
    assert [r.speeding for r in alerts.speeding_flag(speeds).collect()] == [False, True]


@pytest.mark.parametrize(
    "lag,leads,score",
    [(0, 0, "Healthy"), (1, 0, "Healthy"), (2, 0, "Degraded"), (0, 1, "Degraded"), (3, 10, "Degraded"), (4, 0, "Critical"), (0, 11, "Critical")],
)
def test_health_score(spark, lag, leads, score):
    assert spark.range(1).select(quality.health_score(F.lit(lag), F.lit(leads)).alias("s")).first().s == score


def test_ranges_and_nulls(spark):
    mart = driver_mart(
        spark, ("a", DAY, 1.01, 0.0, 0, 0, 0.0), ("b", DAY, 1.0, 12.0, 0, 0, -1000.0), ("c", DAY, 0.0, 12.1, 0, 0, 0.0),
        ("d", DAY, 0.0, 0.0, 0, 0, -1000.1), ("e", DAY - dt.timedelta(days=1), 2.0, 0.0, 0, 0, 0.0), (None, DAY, 0.0, 0.0, 0, 0, 0.0),
    )
    assert {r.driver_id for r in quality.dq_ranges(mart).collect()} == {"a", "c", "d"}
    assert quality.dq_ranges(mart, latest_only=False).count() == 4
    assert quality.dq_nulls(mart, ["driver_id", "date_key"]).first().bad_rows == 1
    assert quality.dq_nulls(mart.limit(0), ["driver_id"]).first().bad_rows == 0
    fresh = quality.dq_freshness(mart, DAY + dt.timedelta(days=2)).first()
    assert (fresh.days_of_lag, fresh.status) == (2, "OUTDATED")


def test_leads_are_text(spark):
    got = quality.investigation_leads(
        vehicle_mart(spark, ("v", DAY, 95.04, 0.0, 0, 12.0)), driver_mart(spark, ("a", DAY, 0.777, 0.0, 0, 0, 0.0)),
        default_thresholds(spark),
    )
    assert sorted(tuple(r) for r in got.collect()) == [("Driver", "a", "High Fatigue", "0.78"), ("Vehicle", "v", "High Temp", "95.0°C")]


def test_executive_kpis_on_empty_marts(spark):
    empty_d = spark.createDataFrame([], schemas.FACT_DRIVER_DAILY_METRICS)
    empty_v = spark.createDataFrame([], schemas.FACT_VEHICLE_DAILY_METRICS)
    assert tuple(overview.executive_kpis(empty_d, empty_v).first()) == (0, 0.0, 0.0, 0, 0)


def test_risky_drivers_order_and_limit(spark):
    mart = driver_mart(spark, *[(f"d{i}", DAY, 0.9 if i < 3 else 0.1, 0.0, 6, 0, 0.0) for i in range(8)])
    got = overview.risky_drivers(mart, default_thresholds(spark)).collect()
    assert [r.driver_id for r in got] == ["d0", "d1", "d2", "d3", "d4"]


def test_streaks_break_on_gaps(spark):
    days = [0, 1, 2, 3, 5, 6, 9]
    mart = driver_mart(spark, *[("a", DAY + dt.timedelta(days=i), 0.9, 0.0, 0, 0, 0.0) for i in days])
    got = drivers.fatigue_streaks(mart, min_days=2).collect()
    assert [(r.days, r.first_day) for r in got] == [(4, DAY), (2, DAY + dt.timedelta(days=5))]
    assert drivers.fatigue_streaks(mart).count() == 1


def test_vehicle_page_for_a_ghost(spark):
    fleet = spark.createDataFrame([("v", None, "ACTIVE", None, None), ("g", None, "ACTIVE", None, None)], schemas.DIM_VEHICLE)
    summary = vehicles.vehicle_summary(fleet, vehicle_mart(spark, ("v", DAY, 95.0, 0.0, 3, 12.0)), DAY, DAY)
    rows = {r.vehicle_id: r for r in summary.collect()}
    assert (rows["g"].active_days, rows["g"].avg_speed, rows["g"].is_ghost) == (0, 0.0, True)
    assert rows["v"].is_ghost is False
    advice = vehicles.maintenance(summary, default_thresholds(spark)).collect()
    assert {(r.vehicle_id, r.recommendation) for r in advice} == {("v", "Temperature Warning"), ("g", "Electrical Warning")}
    one = vehicles.vehicle_summary(fleet, vehicle_mart(spark, ("v", DAY, 95.0, 0.0, 3, 12.0)), DAY, DAY, "v")
    assert one.count() == 1


def test_status_hours_counts_joined_rows(spark):
    people = dim(spark, a="ACTIVE", b="ACTIVE")
    rows = [(f"s{i}", "a", START, 2.0, 0.0, 0.0, True, [], DAY) for i in range(3)]
    got = drivers.status_hours(people, spark.createDataFrame(rows, schemas.FACT_DRIVER_SHIFTS)).first()
    assert (got.driver_count, got.distinct_drivers, got.total_fleet_hours) == (4, 2, 6.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "x double")
    assert {r.bin: r["count"] for r in generic.histogram(df, "x", 10).collect()} == {1: 1, 2: 1, 10: 2}
    same = df.where("x = 1")
    assert {r.bin: r["count"] for r in generic.histogram(same, "x", 10).collect()} == {1: 1}


def test_report_text(spark):
    df = spark.createDataFrame([(0.125, 1234567, dt.datetime(2026, 1, 17, 13, 15)), (None, None, None)], "x double, n bigint, t timestamp_ntz")
    shown = df.select(
        text.percentage("x").alias("pct"), text.fixed("x", 2).alias("fixed"), text.integer("n").alias("int"),
        text.currency("n").alias("money"), text.hours("x").alias("hrs"), text.temperature("x").alias("temp"),
        text.short_time("t").alias("short"), text.activity_time("t").alias("long"),
    ).collect()
    assert tuple(shown[0]) == ("12.5%", "0.12", "1,234,567", "$1,234,567.00", "0.1 hrs", "0.1°C", "17 Jan 13:15", "2026-01-17 13:15")
    assert tuple(shown[1]) == ("—",) * 6 + ("NEVER", "NEVER REPORTED")


def test_severity_words(spark):
    df = spark.createDataFrame([(" critical ",), (None,), ("other",)], "s string")
    got = df.select(text.normalize_severity("s").alias("s"), text.severity_rank("s").alias("r")).collect()
    assert [tuple(r) for r in got] == [("CRITICAL", 2), ("INFO", 0), ("OTHER", None)]


def test_alert_layout(spark):
    assert align(spark.createDataFrame([], schemas.ALERTS), schemas.ALERTS).columns == schemas.ALERTS.names
