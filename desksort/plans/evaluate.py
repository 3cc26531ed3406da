"""Everything the evaluation of a set of predictions produces."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import REVIEW_THRESHOLD
from ..operators import distributions, errors, tally as t
from ..operators.quantiles import exact_quantiles
from ..session import materialize
from ..sinks.summary import evaluation_summary
from ..sinks.tables import write_record


def as_series(predictions: DataFrame) -> DataFrame:
    """``(series, confidence)``, the series being ``correct`` or ``error``."""
    right = F.col("label") == F.col("pred")
    return predictions.select(
        F.when(right, F.lit("correct")).otherwise(F.lit("error")).alias("series"), "confidence"
    )


def evaluate(
    predictions: DataFrame,
    label_map: DataFrame,
    threshold: float = REVIEW_THRESHOLD,
    examples: int = 50,
) -> dict[str, DataFrame]:
    """Result tables by name. ``predictions`` has ``id, label, pred,
    confidence`` and, for the error examples, ``text_clean``.

    The predictions are reduced once to the tally table, written out, and every
    metric reads that. Only the median, the plots' data and the error examples
    go back to the predictions, each reading two or three narrow columns.
    """
    if "text_clean" not in predictions.columns:
        predictions = predictions.withColumn("text_clean", F.lit(None).cast("string"))
    rows = materialize(predictions.select("id", "label", "pred", "confidence", "text_clean"))
    counts = materialize(t.tally(rows, threshold))
    classes = t.per_class(counts)
    series = as_series(rows)
    median = exact_quantiles(rows, "confidence", [0.5])
    metrics = materialize(t.agreement_metrics(classes))
    confidence = materialize(
        t.confidence_summary(counts).withColumn(
            "median_confidence", median.select("value").scalar()
        )
    )
    patterns = errors.top_error_patterns(counts, label_map)
    contrast = errors.error_confidence(counts)
    return {
        "metrics": metrics,
        "confidence": confidence,
        "per_class": t.classification_report(classes, label_map),
        "confusion_matrix": t.confusion_matrix(counts),
        "error_rate": errors.error_rate(counts),
        "category_error_rates": errors.category_error_rates(counts, label_map),
        "top_error_patterns": patterns,
        "error_confidence": contrast,
        "error_examples": errors.confident_errors(rows, label_map, examples),
        "confidence_histogram": distributions.histogram(series, "series", "confidence"),
        "confidence_box_plot": distributions.box_plot(series, "series", "confidence"),
        "summary": evaluation_summary(metrics, confidence, contrast, patterns),
    }


def evaluation_record(
    results: dict[str, DataFrame], split: str, run_at: dt.datetime | None = None
) -> DataFrame:
    """Metrics, per-class report and error analysis as one nested row. Every
    part has at most a few rows per class."""

    def rows(name: str) -> DataFrame:
        df = results[name]
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))))

    def only(name: str) -> DataFrame:
        return results[name].select(F.struct("*"))

    return results["confidence"].select(
        F.lit(run_at).cast("timestamp").alias("timestamp"),
        F.lit(split).alias("split"),
        F.col("n").alias("n_samples"),
        F.struct(
            only("metrics").scalar().alias("agreement"), F.struct("*").alias("confidence")
        ).alias("overall_metrics"),
        rows("per_class").scalar().alias("per_class_metrics"),
        F.struct(
            rows("top_error_patterns").scalar().alias("top_misclassification_patterns"),
            rows("category_error_rates").scalar().alias("category_error_rates"),
            rows("error_confidence").scalar().alias("confidence_analysis"),
        ).alias("error_analysis"),
    )


def write_evaluation(
    results: dict[str, DataFrame], folder: str, split: str, run_at: dt.datetime | None = None
) -> None:
    """Each table as Parquet, and the nested record as JSON."""
    folder = folder.rstrip("/")
    for name, table in results.items():
        table.write.mode("overwrite").parquet(f"{folder}/{split}/{name}")
    write_record(evaluation_record(results, split, run_at), f"{folder}/{split}/results")


def split_evaluation(
    predictions: DataFrame, split: str, threshold: float = REVIEW_THRESHOLD
) -> DataFrame:
    """The short record of one split: accuracy, weighted scores, uncategorized."""
    counts = t.tally(predictions, threshold)
    # Both sides come from the tally, one row each.
    scores = t.agreement_metrics(t.per_class(counts)).select(
        F.lit(split).alias("split"),
        "accuracy", "f1_weighted", "precision_weighted", "recall_weighted",
    )
    doubt = t.confidence_summary(counts).select(
        F.lit(split).alias("split"), "n_uncategorized", "uncategorized_percentage"
    )
    return scores.join(doubt, "split")
