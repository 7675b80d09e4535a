"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadbook.llm.frames import drop, empty, written


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step: links move to ever smaller nodes without changing components.

    Least neighbours come from pre-aggregated sums and are joined to the links, which Spark can split, so a
    node with very many links is no task of its own.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    large = large.distinct()
    small_least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(small_least, "a")
    small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    kept = small_least.select("a", F.col("m").alias("b"))
    return small.unionByName(kept).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for each node that has a link.

    ``links`` has long columns ``a`` and ``b``; direction, repeats and loops don't matter. Each round is
    written to the shared folder; no link or component reaches the driver.
    """
    spark = links.sparkSession
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, path = written(ordered, "links")
    state = _state(current)
    if not state[0]:
        return empty(spark, "node long, root long")
    while True:
        following, next_path = written(_star(current), "links")
        next_state = _state(following)
        drop(spark, path)
        current, path = following, next_path
        if next_state == state:
            break
        state = next_state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple[int, int, int]:
    """Count and two checksums, to see when a round changes nothing."""
    row = links.agg(
        F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
        F.coalesce(F.bit_xor(F.xxhash64("b", "a")), F.lit(0)),
    ).first()
    return tuple(row)
