"""Counts and length statistics of ticket tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their percentage; NULLs are left out. Greatest
    count first, then by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.col("count") * F.lit(100.0) / total).orderBy(
        F.desc("count"), column
    )


def mapping_summary(
    df: DataFrame, original: str = "original_category", mapped: str = "category"
) -> DataFrame:
    return (
        df.where(F.col(original).isNotNull())
        .groupBy(original, mapped)
        .agg(F.count("*").alias("count"))
        .orderBy(original, mapped)
    )


def length_stats(df: DataFrame, columns: Sequence[str] = ("title", "description")) -> DataFrame:
    """Mean, least and greatest length in characters, one row per column."""
    sizes = df.select(*[F.length(c).alias(c) for c in columns])
    wide = sizes.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.avg(c).alias("mean_length"),
            F.min(c).alias("min_length"),
            F.max(c).alias("max_length"),
        ).alias(c)
        for c in columns
    ])
    return wide.select(F.inline(F.array(*columns)))


def split_counts(df: DataFrame, split: str = "split", category: str = "category") -> DataFrame:
    """Rows per split and category, with a NULL-category total per split and a
    grand total."""
    return (
        df.rollup(split, category)
        .agg(F.count("*").alias("count"))
        .orderBy(F.asc_nulls_first(split), F.asc_nulls_first(category))
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``rows / (classes * rows of the class)``, one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    scale = counts.agg((F.sum("count") / F.count("*")).alias("s")).scalar()
    return counts.select(label, "count", (scale / F.col("count")).alias("weight"))


def scoring_counters(df: DataFrame) -> DataFrame:
    """Predictions and mean confidence per category, with a NULL-category row
    for the total. Shape shared by the batch and the streaming counters."""
    return df.rollup("predicted_category").agg(
        F.count("*").alias("predictions"), F.avg("confidence").alias("average_confidence")
    )
