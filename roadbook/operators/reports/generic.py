"""Reports that work on any frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def entities(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null members, sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def severity_top(df: DataFrame, y: str, k: int = 10, tiebreak: str = "entity_id") -> DataFrame:
    """Rows with the largest measure."""
    return df.orderBy(F.desc_nulls_last(y), tiebreak).limit(k)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the smallest and the largest value, empty bins left out.

    The largest value belongs to the last bin. With one distinct value there is one bin.
    """
    values = df.where(F.col(col).isNotNull())
    low = values.select(F.min(col).cast("double").alias("low")).scalar()
    high = values.select(F.max(col).cast("double").alias("high")).scalar()
    placed = values.select(F.col(col).cast("double").alias("v"), low.alias("low"), high.alias("high"))
    # width_bucket is undefined for an empty interval and puts the top value one bin too high
    bin_no = F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(
        F.least(F.width_bucket("v", "low", "high", F.lit(bins)), F.lit(bins)).cast("int")
    )
    width = (F.col("high") - F.col("low")) / bins
    return (
        placed.select(bin_no.alias("bin"), "low", "high")
        .groupBy("bin", "low", "high")
        .agg(F.count("*").alias("count"))
        .select("bin", (F.col("low") + (F.col("bin") - 1) * width).alias("bin_start"), "count")
        .orderBy("bin")
    )
