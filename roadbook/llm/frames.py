"""Small helpers the operators share: Arrow passes over rows, held-out split, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from roadbook.session import scratch_path
from roadbook.sources import storage

#: Characters of text that a pass holds at once; one text may be longer and is then held alone. A pass has arrays of some
#: hundred bytes a character, and its worker keeps their memory for the passes after it.
BLOCK_CHARS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write to the shared folder and read back; the path allows to drop the copy when it is no longer needed."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    storage.delete(spark, path)


def id_text(column: str) -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str) -> Column:
    """Whether crc32 of the id's text is divisible by five; such rows are never learned from."""
    return F.crc32(id_text(column).cast("binary")) % 5 == 0


def blocks(values: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text or list elements, so that a pass holds little at once."""
    lists = pa.types.is_list(values.type) or pa.types.is_large_list(values.type)
    sizes = (pc.list_value_length(values) if lists else pc.binary_length(values)).fill_null(0).to_numpy(False)
    reach, begin = np.cumsum(sizes, dtype=np.int64), 0
    while begin < len(values):
        done = reach[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(reach, done + limit, "right")))
        yield begin, end
        begin = end


def append_columns(
    df: DataFrame, column: str, added: T.StructType, compute: Callable[[list], list[pa.Array]], kind: str = "string",
    keep_source: bool = True,
) -> DataFrame:
    """Rows with the columns ``added`` computed from one column, in one Arrow pass without a shuffle.

    ``compute`` gets a list of values, cast to ``kind``, and returns one Arrow array per added column.
    An input column of the same name as an added one is replaced. Without ``keep_source`` the column that
    is computed from goes, which spares sending it back.
    """
    names = {f.name.lower() for f in added.fields} | (set() if keep_source else {column.lower()})
    keep = [c for c in df.columns if c.lower() not in names]
    frame = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").cast(kind).alias("__value"))
    schema = T.StructType([*frame.schema.fields[:-1], *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column(batch.num_columns - 1)):
                part = batch.slice(begin, end - begin)
                columns = compute(part.column(part.num_columns - 1).to_pylist())
                arrays = [*part.columns[:-1], *columns]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow, strict=True)],
                    schema=arrow,
                )

    return frame.mapInArrow(run, schema)


def filter_rows(df: DataFrame, text_column: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text ``keep`` accepts, all columns unchanged, in one Arrow pass without a shuffle."""
    position = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column(position)):
                part = batch.slice(begin, end - begin)
                mask = keep(part.column(position).to_pylist())
                yield part.filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def stay(df: DataFrame, kept: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Whole rows named by ``kept`` (columns ``id``, ``mark``: :func:`text_mark` of the text), one per name.

    Ids are nearly unique, so no key is hot. Repeated rows with one id and text count as one.
    """
    marked = df.withColumns({"__id": id_key(F.col(f"`{id_column}`")), "__mark": text_mark(F.col(f"`{text_column}`"))})
    names = kept.select(id_key(F.col("id")).alias("__id"), F.col("mark").alias("__mark"))
    return (
        marked.join(names, ["__id", "__mark"], "left_semi")
        .dropDuplicates(["__id", "__mark"])
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


def id_key(column: Column) -> Column:
    """An id as a join key that null ids share with each other only."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def text_mark(column: Column) -> Column:
    """A 128-bit mark of a raw text."""
    return F.md5(F.coalesce(column, F.lit("")).cast("binary"))


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


__all__ = [
    "BLOCK_CHARS", "append_columns", "blocks", "drop", "empty", "filter_rows", "held_out",
    "id_key", "id_text", "stay", "table", "text_mark", "written",
]
