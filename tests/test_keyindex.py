"""The key index of a fact: loads read only the days it names, and an index that says too much does no harm."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from roadbook import schemas
from roadbook.plans import warehouse
from roadbook.sources import keyindex, tables

NAME = "fact_daily_finance"


def finance(spark, *rows):
    full = [(e, "a", dt.date.fromisoformat(day), r, 0.0, r, 0, "hold", 0.0) for e, day, r in rows]
    return spark.createDataFrame(full, schemas.FACT_DAILY_FINANCE)


def stored(spark, root):
    found = tables.read_table(spark, root, NAME).select("event_id", F.col("date_key").cast("string"), "total_revenue")
    return sorted(tuple(r) for r in found.collect())


def indexed(spark, root):
    version = keyindex._versions(spark, root, NAME)[0]
    found = spark.read.schema(keyindex.ENTRY).parquet(keyindex._path(root, NAME, *version))
    return sorted((r.event_id, r.date_key.isoformat()) for r in found.collect())


def spoil(tmp_path, day):
    """Make the files of a day unreadable."""
    for file in (tmp_path / NAME / f"date_key={day}").glob("*.parquet"):
        file.write_bytes(b"no parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("rule", ["replace", "ignore"])
def test_days_that_the_batch_does_not_meet_are_not_read(spark, tmp_path, rule):
    root = str(tmp_path)
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-01", 1.0), ("e2", "2026-01-02", 2.0)), rule)
    spoil(tmp_path, "2026-01-01")
    batch = finance(spark, ("e2", "2026-01-02", 5.0), ("e3", "2026-01-03", 3.0), ("e4", "2026-01-01", 4.0))
    warehouse.load_fact(spark, root, NAME, batch, rule)
    found = tables.read_table(spark, root, NAME).where("date_key > '2026-01-01'").select("event_id", "total_revenue")
    assert sorted(map(tuple, found.collect())) == [("e2", 5.0 if rule == "replace" else 2.0), ("e3", 3.0)]
    with pytest.raises(Exception, match="(?i)parquet"):  # an id of the spoilt day has to be looked up there
        warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-09", 1.0)), rule)


def test_only_named_days_are_scanned(spark, tmp_path):
    root = str(tmp_path)
    warehouse.load_fact(spark, root, NAME, finance(spark, *[(f"e{i}", f"2026-01-{i:02d}", 1.0) for i in range(1, 10)]))
    looked = warehouse.stored_like(spark, root, NAME, finance(spark, ("e3", "2026-02-01", 1.0), ("new", "2026-01-05", 1.0)))
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date_key#\d+ = 2026-01-03", plan)
    nothing = warehouse.stored_like(spark, root, NAME, finance(spark, ("new", "2026-01-05", 1.0)))
    assert nothing.count() == 0 and "FileScan" not in nothing._jdf.queryExecution().executedPlan().toString()


def test_the_index_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path)
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-01", 1.0)))
    version = keyindex._versions(spark, root, NAME)[0]
    batch = tables.materialize(finance(spark, ("e1", "2026-01-01", 1.0)), "batch")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with keyindex._opened(spark, keyindex._path(root, NAME, *version), version[1]) as table:
            plan = keyindex.entries_of(spark.table(table), batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    index_side = plan[plan.index("SortMergeJoin") : plan.index("Exchange")]
    assert "FileScan" in index_side and "Bucketed: true" in index_side


def test_index_is_built_for_a_fact_without_one(spark, tmp_path):
    root = str(tmp_path)
    tables.append_fact(finance(spark, ("e1", "2026-01-01", 1.0), ("e2", "2026-01-02", 2.0)), tables.table_path(root, NAME))
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-04", 7.0)), "ignore")
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e2", "2026-01-04", 7.0)))
    assert stored(spark, root) == [("e1", "2026-01-01", 1.0), ("e2", "2026-01-04", 7.0)]


def test_an_unfinished_index_is_built_anew(spark, tmp_path):
    root = str(tmp_path)
    tables.append_fact(finance(spark, ("e1", "2026-01-01", 1.0)), tables.table_path(root, NAME))
    broken = tmp_path / "key_index" / NAME / "version=1-buckets=4"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"half")
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-01", 5.0)))
    assert stored(spark, root) == [("e1", "2026-01-01", 5.0)]


@pytest.mark.parametrize("rule", ["replace", "ignore"])
def test_entries_of_a_load_that_died_do_no_harm(spark, tmp_path, monkeypatch, rule):
    """Entered, but not stored: the load is repeated and the rows are stored once."""
    root = str(tmp_path)
    warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", "2026-01-01", 1.0)), rule)
    batch = finance(spark, ("e2", "2026-01-02", 2.0))
    with monkeypatch.context() as broken:
        broken.setattr(tables, "append_fact", lambda df, path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.load_fact(spark, root, NAME, batch, rule)
    assert ("e2", "2026-01-02") in indexed(spark, root)
    for _ in range(2):
        warehouse.load_fact(spark, root, NAME, batch, rule)
        assert stored(spark, root) == [("e1", "2026-01-01", 1.0), ("e2", "2026-01-02", 2.0)]


def test_a_row_that_moved_is_found_where_it_is(spark, tmp_path):
    root = str(tmp_path)
    for day, revenue in (("2026-01-01", 1.0), ("2026-01-03", 2.0), ("2026-01-02", 3.0), ("2026-01-01", 4.0)):
        warehouse.load_fact(spark, root, NAME, finance(spark, ("e1", day, revenue)))
        assert stored(spark, root) == [("e1", day, revenue)]


def test_many_loads_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "FILES_PER_BUCKET", 1)
    root, rows = str(tmp_path), [(f"e{i}", f"2026-01-{1 + i % 3:02d}", float(i)) for i in range(24)]
    for begin in range(0, 24, 6):
        warehouse.load_fact(spark, root, NAME, finance(spark, *rows[begin : begin + 6]))
    versions = keyindex._versions(spark, root, NAME)
    assert len(versions) == 1 and versions[0][0] > 1
    assert indexed(spark, root) == sorted((e, d) for e, d, _ in rows) and stored(spark, root) == sorted(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("key_index_")]


def test_new_rows_are_stored_without_another_copy(spark, tmp_path, monkeypatch):
    labels, keep = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, label: labels.append(label) or keep(df, label))
    warehouse.load_fact(spark, str(tmp_path), NAME, finance(spark, ("e1", "2026-01-01", 1.0)), "ignore")
    assert labels == [NAME, f"{NAME}-located"]
    warehouse.load_fact(spark, str(tmp_path), NAME, finance(spark, ("e1", "2026-01-01", 2.0), ("e2", "2026-01-01", 3.0)), "ignore")
    assert stored(spark, str(tmp_path)) == [("e1", "2026-01-01", 1.0), ("e2", "2026-01-01", 3.0)]
    labels.clear()
    warehouse.refresh_marts(spark, str(tmp_path))
    assert labels == [] and not warehouse.pending_loads(spark, str(tmp_path), NAME)
