"""Which days of a fact hold which event ids, so that a load reads only the days it meets.

The index is a narrow table of (event id, day), bucketed by id. A batch is shuffled to the buckets, or broadcast where
the planner finds it small; the index itself is scanned in place. Entries are written before the rows they speak of
and are never taken back, so the index may name a day that does not hold an id (any more), but never lacks one that
does: what it finds has to be looked up in the days it names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from roadbook.sources import storage, tables

#: Files a bucket may have on average before they are merged to one each.
FILES_PER_BUCKET = 8

KEY, ENTRY = "event_id", "event_id string, date_key date"


def _base(root: str, name: str) -> str:
    return tables.table_path(tables.table_path(root, "key_index"), name)


def _versions(spark: SparkSession, root: str, name: str) -> list[tuple[int, int]]:
    """Version and number of buckets of each complete index, the newest first. A first insert that ended makes it so."""
    base = _base(root, name)
    found = [re.fullmatch(r"version=(\d+)-buckets=(\d+)", child) for child in storage.children(spark, base)]
    known = sorted(((int(m[1]), int(m[2])) for m in found if m), reverse=True)
    return [v for v in known if storage.exists(spark, f"{_path(root, name, *v)}/_SUCCESS")]


def _path(root: str, name: str, version: int, buckets: int) -> str:
    return f"{_base(root, name)}/version={version}-buckets={buckets}"


@contextmanager
def _opened(spark: SparkSession, path: str, buckets: int) -> Iterator[str]:
    """The index as a bucketed table of the session's catalog, which knows of it no longer than needed."""
    table = f"key_index_{hashlib.md5(path.encode()).hexdigest()}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({ENTRY}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS "
        f"LOCATION '{place}'"
    )
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _insert(entries: DataFrame, table: str, buckets: int) -> None:
    """One file a bucket at most: rows are dealt as the table deals them."""
    entries.select(KEY, "date_key").repartition(buckets, KEY).distinct().write.insertInto(table)


def _current(spark: SparkSession, root: str, name: str) -> tuple[int, int]:
    """The newest index; it is built from the fact where there is none yet."""
    known = _versions(spark, root, name)
    if known:
        return known[0]
    storage.delete(spark, _base(root, name))
    version = (1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with _opened(spark, _path(root, name, *version), version[1]) as table:
        _insert(tables.read_table(spark, root, name), table, version[1])
    return version


def locate(spark: SparkSession, root: str, name: str, ids: DataFrame) -> DataFrame:
    """``event_id`` and ``date_key`` of the days that may hold the ids of ``ids``, written to the scratch folder."""
    version = _current(spark, root, name)
    with _opened(spark, _path(root, name, *version), version[1]) as table:
        return tables.materialize(entries_of(spark.table(table), ids), f"{name}-located")


def entries_of(index: DataFrame, ids: DataFrame) -> DataFrame:
    return index.join(ids.select(KEY), KEY, "left_semi").select(KEY, "date_key")


def note(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    """Enter rows that are about to be stored; merge the buckets' files when they have become many."""
    version, buckets = _current(spark, root, name)
    path = _path(root, name, version, buckets)
    with _opened(spark, path, buckets) as table:
        _insert(rows, table, buckets)
        if len(storage.files(spark, path)) > FILES_PER_BUCKET * buckets:
            _merge(spark, root, name, spark.table(table), version, buckets)


def _merge(spark: SparkSession, root: str, name: str, entries: DataFrame, version: int, buckets: int) -> None:
    """The next version of the index, with more buckets where the session has more; when it is complete, older ones go."""
    following = (version + 1, max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    storage.delete(spark, _path(root, name, *following))
    with _opened(spark, _path(root, name, *following), following[1]) as table:
        _insert(entries, table, following[1])
    for old in _versions(spark, root, name)[1:]:
        storage.delete(spark, _path(root, name, *old))
