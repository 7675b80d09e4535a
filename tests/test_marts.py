import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadbook import schemas
from roadbook.functions.expressions import high_water, latest, trailing
from roadbook.operators import marts
from roadbook.sources.reference import default_thresholds

D1, D2 = dt.date(2026, 2, 7), dt.date(2026, 2, 8)


def tel(spark, *rows):
    """(event, vehicle, driver, day, speed, temp, volts, speeding)"""
    full = [
        (e, v, d, dt.datetime(day.year, day.month, day.day, 8), 0.0, 0.0, s, 50.0, t, b, sp, day)
        for e, v, d, day, s, t, b, sp in rows
    ]
    return spark.createDataFrame(full, schemas.FACT_VEHICLE_TELEMETRY)


def shifts(spark, *rows):
    """(event, driver, day, hours, continuous, fatigue, alerts)"""
    full = [
        (e, d, dt.datetime(day.year, day.month, day.day, 18), h, c, f, f is not None and f < 0.6, a, day)
        for e, d, day, h, c, f, a in rows
    ]
    return spark.createDataFrame(full, schemas.FACT_DRIVER_SHIFTS)


def fin(spark, *rows):
    """(event, driver, day, revenue, cost, fraud)"""
    full = [(e, d, day, r, c, r - c, n, "hold", 0.0) for e, d, day, r, c, n in rows]
    return spark.createDataFrame(full, schemas.FACT_DAILY_FINANCE)


def dim(spark, **status):
    return spark.createDataFrame([(k, v, None, None) for k, v in status.items()], schemas.DIM_DRIVER)


def mart_rows(df):
    return {(r.driver_id, r.date_key): r for r in df.collect()}


def test_driver_mart(spark):
    got = mart_rows(
        marts.driver_daily_metrics(
            tel(spark, ("t1", "BUS_1", "a", D1, 60.0, 90.0, 12.0, True), ("t2", "BUS_1", "a", D1, 40.0, 90.0, 12.0, False),
                ("t3", "BUS_1", "b", D1, None, None, None, None), ("t4", "BUS_1", "lost", D1, 1.0, 1.0, 1.0, False)),
            shifts(spark, ("s1", "a", D1, 6.0, 4.0, 0.5, ["x", "y"]), ("s2", "a", D1, 7.0, 3.0, 1.0, []),
                   ("s3", "r", D2, 20.0, 12.0, 0.9, None)),
            fin(spark, ("f1", "a", D2, 10.0, 4.0, 2)),
            dim(spark, a="ACTIVE", b="ACTIVE", r="RETIRED"),
        )
    )
    assert set(got) == {("a", D1), ("b", D1), ("r", D2), ("a", D2)}
    a1 = got["a", D1]
    assert (a1.total_events, a1.avg_speed_kph, a1.speeding_events) == (2, 50.0, 1)
    assert (a1.total_shift_hours, a1.max_continuous_hours, a1.avg_fatigue_index, a1.alerts_count) == (13.0, 4.0, 0.75, 2)
    assert (a1.total_revenue, a1.fraud_alerts_count) == (0.0, 0)
    assert (a1.speeding_alert, a1.fatigue_alert, a1.fraud_alert) == (True, True, False)
    # no telemetry: the speeding flag is unknown, the others are not
    a2 = got["a", D2]
    assert (a2.total_events, a2.speeding_alert, a2.fatigue_alert, a2.fraud_alert) == (0, None, False, True)
    assert got["b", D1].avg_speed_kph == 0.0 and got["b", D1].speeding_alert is False
    assert got["r", D2].fatigue_alert is False


@pytest.mark.parametrize("fatigue,hours,flag", [(0.7, 8.0, False), (0.71, 0.0, True), (0.0, 8.1, True)])
def test_fatigue_limits_are_strict(spark, fatigue, hours, flag):
    got = marts.driver_daily_metrics(
        tel(spark), shifts(spark, ("s", "a", D1, 1.0, hours, fatigue, [])), fin(spark), dim(spark, a="ACTIVE")
    ).first()
    assert got.fatigue_alert is flag


def test_latest_day_of_shipped_shape(spark):
    """Six drivers of one day, as in the documented example."""
    data = [
        ("DR_001", 6.1, 4.8, 0.77, 1, 283.60, 1), ("DR_002", 6.2, 4.5, 0.83, 1, 353.73, 3), ("DR_003", 9.4, 2.3, 0.30, 0, 209.69, 3),
        ("DR_004", 6.7, 2.8, 0.37, 0, 693.42, 1), ("DR_005", 9.8, 5.2, 0.93, 1, 589.59, 3), ("DR_006", 7.8, 2.7, 0.45, 0, 703.12, 1),
    ]
    from roadbook.operators import alerts

    mart = marts.driver_daily_metrics(
        tel(spark),
        shifts(spark, *[(f"s{d}", d, D2, h, c, f, ["fatigue_risk"] * n) for d, h, c, f, n, _, _ in data]),
        fin(spark, *[(f"f{d}", d, D2, p, 0.0, fr) for d, *_, p, fr in data]),
        dim(spark, **{d: "ACTIVE" for d, *_ in data}),
    )
    assert {r.driver_id for r in mart.where("fatigue_alert").collect()} == {"DR_001", "DR_002", "DR_005"}
    thresholds = default_thresholds(spark)
    fatigue = alerts.alert_fatigue(mart, dim(spark, **{d: "ACTIVE" for d, *_ in data}), thresholds).collect()
    assert {(r.entity_id, r.metric_value, r.severity) for r in fatigue} == {
        ("DR_001", 0.8, "WARNING"), ("DR_002", 0.8, "CRITICAL"), ("DR_005", 0.9, "CRITICAL"),
    }
    assert alerts.alert_fraud(mart).count() == 6
    assert round(mart.agg(F.sum("net_profit")).first()[0], 2) == 2833.15


def test_vehicle_mart_flags(spark):
    got = marts.vehicle_daily_metrics(
        tel(spark, *[(f"t{i}", "BUS_1", "a", D1, 10.0 * i, 90.0, 11.8, i == 0) for i in range(12)],
            ("n", "CAR_1", "a", D1, None, None, None, None)),
        default_thresholds(spark),
    )
    rows = {r.vehicle_id: r for r in got.collect()}
    bus = rows["BUS_1"]
    assert (bus.telemetry_events, bus.max_speed_kph, bus.speeding_rate) == (12, 110.0, 0.083)
    # limits are strict: exactly on the limit is no alert
    assert (bus.speeding_alert, bus.engine_temp_alert, bus.battery_alert) == (True, False, False)
    car = rows["CAR_1"]
    assert (car.engine_temp_alert, car.battery_alert, car.speeding_alert) == (None, None, False)


def facts(seed, days, spark):
    rnd = random.Random(seed)
    t, s, f = [], [], []
    for i in range(120):
        day = D1 + dt.timedelta(days=rnd.randrange(days))
        d = rnd.choice("abc")
        t.append((f"t{seed}{i}", f"BUS_{rnd.randrange(3)}", d, day, float(rnd.randrange(100)), 80.0, 12.0, rnd.random() < 0.2))
        s.append((f"s{seed}{i}", d, day, 1.0, 2.0, rnd.randrange(64) / 64, ["x"] * rnd.randrange(3)))
        f.append((f"f{seed}{i}", d, day, float(rnd.randrange(50)), 5.0, rnd.randrange(2)))
    return tel(spark, *t), shifts(spark, *s), fin(spark, *f)


def as_rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_touched_keys_equals_full_rebuild_and_is_idempotent(spark):
    first, second = facts(1, 3, spark), facts(2, 5, spark)
    drivers = dim(spark, a="ACTIVE", b="RETIRED", c="ACTIVE")
    both = [x.unionByName(y) for x, y in zip(first, second)]
    full = marts.driver_daily_metrics(*both, drivers)
    mart = marts.driver_daily_metrics(*first, drivers)
    touched = marts.changed_driver_days(*second)
    once = marts.refresh_driver(mart, *both, drivers, policy="touched_keys", touched=touched)
    assert as_rows(once) == as_rows(full)
    assert as_rows(marts.refresh_driver(once, *both, drivers, policy="touched_keys", touched=touched)) == as_rows(full)


def test_high_watermark_leaves_old_days(spark):
    first, second = facts(1, 3, spark), facts(2, 5, spark)
    drivers = dim(spark, a="ACTIVE", b="ACTIVE", c="ACTIVE")
    both = [x.unionByName(y) for x, y in zip(first, second)]
    mart = marts.driver_daily_metrics(*first, drivers)
    got = marts.refresh_driver(mart, *both, drivers)
    mark = D1 + dt.timedelta(days=2)
    full = marts.driver_daily_metrics(*both, drivers)
    assert as_rows(got.where(F.col("date_key") <= mark)) == as_rows(mart)
    assert as_rows(got.where(F.col("date_key") > mark)) == as_rows(full.where(F.col("date_key") > mark))
    with pytest.raises(ValueError):
        marts.refresh_driver(mart, *both, drivers, policy="other")
    with pytest.raises(ValueError):
        marts.refresh_driver(mart, *both, drivers, policy="touched_keys")


def test_marks_on_empty_mart(spark):
    empty = spark.createDataFrame([], schemas.FACT_DRIVER_DAILY_METRICS)
    assert spark.range(1).select(high_water(empty).alias("m")).first().m == dt.date(1900, 1, 1)
    assert latest(empty).count() == 0


def test_trailing_takes_eight_dates(spark):
    days = spark.createDataFrame([(D1 - dt.timedelta(days=i),) for i in range(20)], "date_key date")
    assert trailing(days, 7).count() == 8


def test_trip_reconciliation(spark):
    trips = spark.createDataFrame(
        [("t1", "f1", "a", "2026-02-07T01:00:00Z", 10.0, 1.0, 0.0, 0.0, 1.0, True),
         ("t2", "f1", "a", "2026-02-07T02:00:00Z", 5.005, 1.0, 0.0, 0.0, 1.0, None)], schemas.STAGED_TRIPS,
    )
    day = marts.rollup_trips(trips).first()
    assert (day.total_cost, day.fraud_alerts_count, day.date_key) == (2.0, 1, D1)
    declared = fin(spark, ("f1", "a", D1, day.total_revenue, 2.0, 1), ("f2", "b", D1, 1.0, 0.0, 0))
    assert [r.driver_id for r in marts.reconcile_finance(declared, trips).collect()] == ["b"]
