import datetime as dt

import pytest

from pyspark.sql import functions as F

from roadbook import schemas
from roadbook.operators import dimensions, upserts
from roadbook.plans import warehouse
from roadbook.sources import reference, tables

KEYED = "k int, v string, n int"


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), KEYED)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_and_insert_ignore(spark):
    base = keyed(spark, (1, "old", 0), (2, "old", 0))
    incoming = keyed(spark, (2, "new", 2), (2, "newer", 1), (3, "new", 1), (3, "other", 9))
    assert rows(upserts.upsert(base, incoming, ["k"], ["n"])) == [(1, "old", 0), (2, "newer", 1), (3, "new", 1)]
    assert rows(upserts.insert_ignore(base, incoming, ["k"], ["n"])) == [(1, "old", 0), (2, "old", 0), (3, "new", 1)]
    twice = upserts.upsert(upserts.upsert(base, incoming, ["k"], ["n"]), incoming, ["k"], ["n"])
    assert rows(twice) == rows(upserts.upsert(base, incoming, ["k"], ["n"]))


def test_delete_keys(spark):
    base = keyed(spark, (1, "a", 0), (1, "b", 0), (2, "a", 0))
    assert rows(upserts.delete_keys(base, base.where("k = 1"), ["k", "v"])) == [(2, "a", 0)]


T70, T26 = dt.datetime(1970, 1, 1), dt.datetime(2026, 1, 5)


def test_driver_merge_keeps_known_timestamps(spark):
    dim = spark.createDataFrame(
        [("a", "ACTIVE", T26, T26), ("b", "ACTIVE", T70, T70), ("gone", "ACTIVE", T26, T26)], schemas.DIM_DRIVER
    )
    master = spark.createDataFrame([("a", "RETIRED"), ("b", "ACTIVE"), ("c", "ACTIVE")], "driver_id string, status string")
    later = dt.datetime(2026, 2, 1)
    shifts = spark.createDataFrame([("c", later), ("c", T26)], "driver_id string, event_timestamp timestamp_ntz")
    got = {r.driver_id: tuple(r)[1:] for r in dimensions.build_dim_driver(dim, master, shifts).collect()}
    assert got == {
        "a": ("RETIRED", T26, T26),
        "b": ("ACTIVE", None, None),
        "c": ("ACTIVE", T26, later),
        "gone": ("ACTIVE", T26, T26),
    }


def test_vehicle_dimension(spark):
    dim = spark.createDataFrame([("BUS_1", "CAR", "ACTIVE", T26, T26)], schemas.DIM_VEHICLE)
    master = spark.createDataFrame([("BUS_1", "MAINTENANCE"), ("VAN_1", "ACTIVE")], "vehicle_id string, status string")
    tel = spark.createDataFrame([("VAN_1", T26), (None, T26)], "vehicle_id string, event_timestamp timestamp_ntz")
    got = {r.vehicle_id: tuple(r)[1:] for r in dimensions.build_dim_vehicle(dim, master, tel).collect()}
    assert got == {"BUS_1": ("BUS", "MAINTENANCE", None, None), "VAN_1": ("UNKNOWN", "ACTIVE", T26, T26)}
    # a null in the fact must not blank everybody
    assert upserts.reset_unseen(dim, tel.withColumn("vehicle_id", F.lit("BUS_1"))).first().last_seen_at == T26


def test_null_epoch_forms(spark):
    dim = spark.createDataFrame([("a", "x", T26, None)], schemas.DIM_DRIVER)
    assert upserts.null_epoch(dim).first().first_seen_at is None
    assert upserts.null_epoch(dim, null_when_missing=False).first().first_seen_at == T26


def test_calendar(spark):
    cal = dimensions.build_dim_date(spark, dt.date(2025, 1, 1), dt.date(2027, 12, 31))
    assert cal.count() == 1095
    assert cal.schema == schemas.DIM_DATE or cal.schema.names == schemas.DIM_DATE.names
    sunday = cal.where("date_key = DATE '2026-02-08'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_of_year) == ("Sunday", True, 6)


def test_thresholds_seed(spark):
    assert reference.default_thresholds(spark).count() == 5


def test_versions(spark, tmp_path):
    path = str(tmp_path / "dim_driver")
    root = str(tmp_path)
    assert tables.read_current(spark, root, "dim_driver").count() == 0
    one = spark.createDataFrame([("a", "ACTIVE", None, None)], schemas.DIM_DRIVER)
    tables.replace_table(one, path)
    stored = tables.read_current(spark, root, "dim_driver")
    tables.replace_table(stored.unionByName(one.withColumn("driver_id", F.lit("b"))), path)
    assert tables.read_current(spark, root, "dim_driver").count() == 2
    tables.replace_table(stored.limit(0), path)
    assert tables.read_current(spark, root, "dim_driver").count() == 0
    assert tables.read_version(spark, path, schemas.DIM_DRIVER, below=3).count() == 2


def finance(spark, *rows):
    full = [(e, d, dt.date.fromisoformat(day), r, 0.0, r, 0, "hold", 0.0) for e, d, day, r in rows]
    return spark.createDataFrame(full, schemas.FACT_DAILY_FINANCE)


def test_load_fact_replace_moves_days(spark, tmp_path):
    root, name = str(tmp_path), "fact_daily_finance"
    warehouse.load_fact(spark, root, name, finance(spark, ("e1", "a", "2026-01-01", 1.0), ("e2", "a", "2026-01-02", 2.0)))
    warehouse.settle(spark, root, {name: warehouse.pending_loads(spark, root, name)})
    warehouse.load_fact(spark, root, name, finance(spark, ("e1", "a", "2026-01-03", 9.0)))
    touched = warehouse.pending(spark, root, name)
    assert rows(touched.select(F.col("date_key").cast("string"))) == [("2026-01-01",), ("2026-01-03",)]
    stored = tables.read_table(spark, root, name)
    assert rows(stored.select("event_id", "total_revenue")) == [("e1", 9.0), ("e2", 2.0)]
    # identity columns must be present
    bad = finance(spark, ("e9", "a", "2026-01-05", 1.0)).withColumn("driver_id", F.lit(None).cast("string"))
    warehouse.load_fact(spark, root, name, bad)
    assert tables.read_table(spark, root, name).count() == 2


def test_load_fact_ignore_is_repeatable(spark, tmp_path):
    root, name = str(tmp_path), "fact_daily_finance"
    batch = finance(spark, ("e1", "a", "2026-01-01", 1.0), ("e1", "a", "2026-01-01", 5.0))
    for _ in range(2):
        warehouse.load_fact(spark, root, name, batch, "ignore")
        # the marts were not refreshed, so after the repeated load the key is still named
        assert warehouse.pending(spark, root, name).count() == 1
    warehouse.settle(spark, root, {name: warehouse.pending_loads(spark, root, name)})
    warehouse.load_fact(spark, root, name, batch, "ignore")
    assert warehouse.pending(spark, root, name).count() == 0
    assert rows(tables.read_table(spark, root, name).select("total_revenue")) == [(1.0,)]


def test_rows_stored_as_they_are_touch_nothing(spark, tmp_path):
    root, name = str(tmp_path), "fact_daily_finance"
    batch = finance(spark, ("e1", "a", "2026-01-01", 1.0), ("e2", "a", "2026-01-02", 2.0))
    warehouse.load_fact(spark, root, name, batch)
    warehouse.settle(spark, root, {name: warehouse.pending_loads(spark, root, name)})
    files = sorted(str(p) for p in (tmp_path / name).rglob("*.parquet"))
    warehouse.load_fact(spark, root, name, batch)
    assert warehouse.pending(spark, root, name).count() == 0
    assert sorted(str(p) for p in (tmp_path / name).rglob("*.parquet")) == files
    warehouse.load_fact(spark, root, name, finance(spark, ("e2", "a", "2026-01-02", 3.0)))
    left = {str(p) for p in (tmp_path / name).rglob("*.parquet")}
    assert {f for f in files if "2026-01-01" in f} <= left and not {f for f in files if "2026-01-02" in f} & left


def test_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    root, name = str(tmp_path), "fact_daily_finance"
    warehouse.load_fact(spark, root, name, finance(spark, ("e1", "a", "2026-01-01", 1.0), ("e2", "a", "2026-01-01", 2.0)))
    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_fact", lambda df, path: tables.drop_days(spark, path, [dt.date(2026, 1, 1)]) or 1 / 0)
        with pytest.raises(ZeroDivisionError):  # dies after the day is deleted, before the new one is there
            warehouse.load_fact(spark, root, name, finance(spark, ("e1", "a", "2026-01-03", 9.0)))
    assert tables.read_table(spark, root, name).count() == 0
    warehouse.load_fact(spark, root, name, finance(spark, ("e1", "a", "2026-01-03", 9.0)))
    assert rows(tables.read_table(spark, root, name).select("event_id", "total_revenue")) == [("e1", 9.0), ("e2", 2.0)]


def test_choice_inside_a_batch_is_reproducible_by_arrays(spark, tmp_path):
    day = dt.date(2026, 1, 1)
    full = [("e", "d", dt.datetime(2026, 1, 1), 1.0, 1.0, 0.5, True, a, day) for a in (["b"], ["a"], ["c"])]
    kept = []
    for k in range(3):
        root = str(tmp_path / str(k))
        warehouse.load_fact(spark, root, "fact_driver_shifts", spark.createDataFrame(full[k:] + full[:k], schemas.FACT_DRIVER_SHIFTS))
        kept.append(tables.read_table(spark, root, "fact_driver_shifts").first().alerts)
    assert kept == [["a"]] * 3


def test_versions_are_pruned_and_read_when_committed(spark, tmp_path):
    path, one = str(tmp_path / "t"), spark.createDataFrame([(1,)], "x int")
    for version in range(1, 6):
        tables.replace_table(one, path, version=version, keep=2)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version=4", "version=5"]
    (tmp_path / "t" / "version=5" / "_SUCCESS").unlink()
    assert tables.read_versions(spark, path, one.schema).count() == 1
    assert tables.read_version(spark, path, one.schema).count() == 1
