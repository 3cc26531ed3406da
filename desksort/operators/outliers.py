"""Length band between two percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def length_band(
    df: DataFrame, column: str, min_percentile: float = 1, max_percentile: float = 99
) -> DataFrame:
    """One row ``(min_threshold, max_threshold)``, exact and interpolated."""
    low, high = min_percentile / 100, max_percentile / 100
    marks = exact_quantiles(df, column, [low, high])

    def at(q: float):
        return F.max(F.when(F.col("quantile") == q, F.col("value")))

    return marks.agg(at(low).alias("min_threshold"), at(high).alias("max_threshold"))


def keep_band(df: DataFrame, column: str, band: DataFrame) -> DataFrame:
    ends = band.select(F.struct("min_threshold", "max_threshold").alias("_b")).scalar()
    return df.where(
        (F.col(column) >= ends["min_threshold"]) & (F.col(column) <= ends["max_threshold"])
    )


def band_stats(df: DataFrame, column: str, band: DataFrame) -> DataFrame:
    """Rows before and after, the thresholds, and how many fell on each side."""
    ends = band.select(F.struct("min_threshold", "max_threshold").alias("_b")).scalar()
    marked = df.select(F.col(column).alias("_c"), ends.alias("_b")).select(
        "_c", F.col("_b.min_threshold").alias("_low"), F.col("_b.max_threshold").alias("_high")
    )
    inside = (F.col("_c") >= F.col("_low")) & (F.col("_c") <= F.col("_high"))
    return marked.agg(
        F.count("*").alias("initial_count"),
        F.count_if(inside).alias("final_count"),
        (F.count("*") - F.count_if(inside)).alias("removed"),
        F.max("_low").alias("min_threshold"),
        F.max("_high").alias("max_threshold"),
        F.count_if(F.col("_c") < F.col("_low")).alias("too_short"),
        F.count_if(F.col("_c") > F.col("_high")).alias("too_long"),
    )
