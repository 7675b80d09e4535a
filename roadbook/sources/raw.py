"""Raw lake: newline-delimited JSON, one object per line, many files per domain."""

from __future__ import annotations

from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from roadbook.sources import storage


#: Column that takes the text of a line that does not fit its schema.
MISFIT = "_misfit"


def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Typed columns next to the raw text.

    ``present_keys`` lists the columns whose key the object really carries (a key with a JSON null
    counts, an unparsable line gives null) and ``bad_types`` the columns whose key has a value of
    another type, which a parsed column alone cannot tell.

    A line is parsed once. Its keys are listed only if a column is null, and its values are read as
    text only if the parser says that the line does not fit.
    """
    with_misfit = T.StructType([*schema.fields, T.StructField(MISFIT, T.StringType())])
    parsed = F.from_json(line, with_misfit, {"columnNameOfCorruptRecord": MISFIT})
    # Generated columns are computed once per line. Plain columns would be copied into every
    # later filter and check, and each copy would parse the text again.
    typed = lines.select("*", F.inline(F.array(F.struct(parsed.alias("parsed")))))
    names = F.lit(schema.names)
    complete = reduce(and_, [F.col(f"parsed.{name}").isNotNull() for name in schema.names])
    keys = F.when(complete, names).otherwise(F.array_intersect(names, F.json_object_keys(line)))
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    texts = F.when(F.col(f"parsed.{MISFIT}").isNotNull(), F.from_json(line, as_text))
    # a value that is there but is no value of its column's type
    bad_types = [
        F.when(F.col(f"texts.{f.name}").isNotNull() & F.col(f"parsed.{f.name}").isNull(), F.lit(f.name))
        for f in schema if f.dataType != T.StringType()
    ]
    record = F.struct(keys.alias("present_keys"), texts.alias("texts"))
    return typed.select("*", F.inline(F.array(record))).select(
        *lines.columns, "present_keys", F.array_compact(F.array(*bad_types)).cast("array<string>").alias("bad_types"),
        *[F.col(f"parsed.{name}") for name in schema.names],
    )


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line of every file below ``path``, in folders of any depth; no file at all is an error."""
    if not storage.has_input(spark, path):
        raise FileNotFoundError(f"no raw files at {path}")
    return read_files(spark, [path], schema)


def read_files(spark: SparkSession, paths: list[str], schema: T.StructType, below: str | None = None) -> DataFrame:
    """Every line of the given files or folders, with the file it comes from.

    ``file_name`` is the bare name or, with ``below``, the path from that folder on.
    """
    name = F.col("_metadata.file_name")
    if below is not None:
        base = storage.raw_path(spark, below) + "/"
        path = F.col("_metadata.file_path")
        # addresses are percent-encoded, but decoding takes a plus for a blank
        encoded = F.replace(F.substring(path, F.instr(path, base) + len(base), F.length(path)), F.lit("+"), F.lit("%2B"))
        name = F.url_decode(encoded)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).select(
        "value", F.col("_metadata.file_path").alias("source_file"), name.alias("file_name")
    )
    return parse_lines(lines, schema)


def list_raw(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path from the folder on, length and time of change of all files below a raw folder; none at all is an error."""
    found = storage.tree(spark, path) if storage.has_input(spark, path) else []
    if not found:
        raise FileNotFoundError(f"no raw files at {path}")
    base = unquote(storage.raw_path(spark, path)) + "/"
    return [(name[name.index(base) + len(base) :], *state) for name, *state in found]


def write_raw(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Append a drop to the lake, or replace the whole folder.

    Null fields are written as JSON nulls: a consumer tells a null from an absent key.
    """
    writer = df.write.mode("overwrite" if overwrite else "append")
    writer.option("ignoreNullFields", "false").json(path)
