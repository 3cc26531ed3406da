"""What the classifier gets wrong. All but ``confident_errors`` work on the
tally table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .labels import decode
from .tally import pooled


def error_rate(counts: DataFrame) -> DataFrame:
    wrong = F.sum(F.when(F.col("label") != F.col("pred"), F.col("n")).otherwise(0))
    return counts.agg(
        F.sum("n").alias("n"), wrong.alias("n_errors"), (wrong / F.sum("n")).alias("error_rate")
    )


def category_error_rates(counts: DataFrame, label_map: DataFrame) -> DataFrame:
    wrong = F.sum(F.when(F.col("label") != F.col("pred"), F.col("n")).otherwise(0))
    rates = counts.groupBy("label").agg(
        wrong.alias("errors"), F.sum("n").alias("total"), (wrong / F.sum("n")).alias("error_rate")
    )
    return (
        decode(rates, label_map).select("category", "errors", "total", "error_rate").orderBy("category")
    )


def error_patterns(counts: DataFrame, label_map: DataFrame) -> DataFrame:
    """(true, predicted) pairs with their count and percentage of all errors."""
    wrong = counts.where(F.col("label") != F.col("pred"))
    total = wrong.agg(F.sum("n")).scalar()
    named = decode(decode(wrong, label_map, "label", "true_category"), label_map, "pred", "predicted_category")
    return named.select(
        "true_category",
        "predicted_category",
        F.col("n").alias("count"),
        (F.col("n") / total * 100).alias("percentage"),
        "first_seen",
    )


def top_error_patterns(counts: DataFrame, label_map: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent pairs, ranked from 1; of equals, the one seen first."""
    order = (F.desc("count"), F.asc("first_seen"))
    top = error_patterns(counts, label_map).orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "*").drop("first_seen")


def error_confidence(counts: DataFrame) -> DataFrame:
    """Mean and population deviation of confidence, errors against correct."""
    marked = counts.withColumn("is_error", F.col("label") != F.col("pred"))
    return pooled(marked, "is_error")


def confident_errors(
    predictions: DataFrame, label_map: DataFrame, n: int = 20, order: str = "id"
) -> DataFrame:
    """The n errors the model was surest of, by confidence then ``order``."""
    top = (
        predictions.where(F.col("label") != F.col("pred"))
        .orderBy(F.desc("confidence"), F.asc(order))
        .limit(n)
    )
    named = decode(decode(top, label_map, "label", "true_category"), label_map, "pred", "predicted_category")
    return named.orderBy(F.desc("confidence"), F.asc(order)).select(
        "text_clean", "true_category", "predicted_category", "confidence"
    )
