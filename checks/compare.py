"""Run one query on Spark and its SQL on DuckDB and compare names, types, row counts, values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t):
        return "float"
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_kind(t.value_type)}>"
    return str(t)


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v)) for k, v in value.items()))
    if isinstance(value, list):
        return tuple(_norm(v) for v in value)
    return value


def rows(table: pa.Table) -> list[str]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(repr(tuple(_norm(v) for v in row)) for row in zip(*columns))


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    out = []
    left = {n: _kind(spark_table.schema.field(n).type) for n in spark_table.column_names}
    right = {n: _kind(duck_table.schema.field(n).type) for n in duck_table.column_names}
    if left != right:
        out.append(f"schema {sorted(set(left.items()) ^ set(right.items()))}")
    if sorted(left) == sorted(right):
        a, b = rows(spark_table), rows(duck_table)
        if len(a) != len(b):
            out.append(f"rows {len(a)} vs {len(b)}")
        if a != b:
            only_a = [x for x in a if x not in set(b)][:2]
            only_b = [x for x in b if x not in set(a)][:2]
            out.append(f"values spark={only_a} duck={only_b}")
    return out
