"""The evaluation summary as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluation_summary(
    metrics: DataFrame,
    confidence: DataFrame,
    error_confidence: DataFrame,
    top_patterns: DataFrame,
    patterns_shown: int = 5,
) -> DataFrame:
    """``(section, line_no, text)`` from one-row metric tables and the pattern
    table. Lines whose figure is NULL are left out."""
    means = error_confidence.agg(
        F.max(F.when(F.col("is_error"), F.col("mean_confidence"))).alias("wrong"),
        F.max(F.when(~F.col("is_error"), F.col("mean_confidence"))).alias("right"),
    )

    def line(section: str, no: int, text: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(no).alias("line_no"), text.alias("text")
        )

    def figure(title: str, value: str, shape: str = "%.4f") -> Column:
        return F.when(
            F.col(value).isNotNull(), F.format_string(f"{title}: {shape}", F.col(value))
        )

    def share(text: str, value: str) -> Column:
        return F.when(F.col(value).isNotNull(), F.format_string(text, F.col(value) * 100))

    # Titles and sentences of the report, which readers compare.
    overall = metrics.select(F.inline(F.array(
        line("OVERALL METRICS", 1, figure("Accuracy", "accuracy")),
        line("OVERALL METRICS", 2, figure("Balanced Accuracy", "balanced_accuracy")),
        line("OVERALL METRICS", 3, figure("F1-Score (weighted)", "f1_weighted")),
        line("OVERALL METRICS", 4, figure("F1-Score (macro)", "f1_macro")),
        line("OVERALL METRICS", 5, figure("Precision (weighted)", "precision_weighted")),
        line("OVERALL METRICS", 6, figure("Recall (weighted)", "recall_weighted")),
        line("OVERALL METRICS", 7, figure("Cohen's Kappa", "cohen_kappa")),
        line("KEY INSIGHTS", 1, share("Model correctly classifies %.2f%% of tickets", "accuracy")),
        line("KEY INSIGHTS", 4, F.when(
            F.col("cohen_kappa").isNotNull(),
            F.format_string(
                "Strong agreement between model and ground truth (Kappa: %.4f)",
                F.col("cohen_kappa"),
            ),
        )),
    )))
    sure = confidence.select(F.inline(F.array(
        line("CONFIDENCE ANALYSIS", 1, figure("Mean confidence", "mean_confidence")),
        line("CONFIDENCE ANALYSIS", 2, share("High confidence rate: %.2f%%", "high_confidence_rate")),
        line("CONFIDENCE ANALYSIS", 3, figure("Accuracy (high conf)", "accuracy_high_confidence")),
        line("CONFIDENCE ANALYSIS", 4, figure("Accuracy (low conf)", "accuracy_low_confidence")),
        line("KEY INSIGHTS", 2, share(
            "%.2f%% can be auto-assigned with high confidence", "high_confidence_rate"
        )),
    )))
    contrast = means.select(F.inline(F.array(line("KEY INSIGHTS", 3, F.when(
        F.col("wrong").isNotNull() & F.col("right").isNotNull(),
        F.format_string(
            "Errors have %.2f avg confidence (vs %.2f for correct)", F.col("wrong"), F.col("right")
        ),
    )))))
    patterns = top_patterns.where(F.col("rank") <= patterns_shown).select(
        F.lit("TOP MISCLASSIFICATION PATTERNS").alias("section"),
        F.col("rank").alias("line_no"),
        F.format_string(
            "%s → %s: %d (%.2f%%)", "true_category", "predicted_category", "count", "percentage"
        ).alias("text"),
    )
    return (
        overall.unionByName(sure).unionByName(contrast).unionByName(patterns)
        .where(F.col("text").isNotNull())
    )
