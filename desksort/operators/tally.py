"""One pass over the predictions, and the metrics that follow from it.

``tally`` reduces predictions to one row per (true, predicted) pair. Every
metric, report and error statistic below works on that table, whose size is the
square of the number of classes and does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import REVIEW_THRESHOLD


def tally(
    predictions: DataFrame,
    threshold: float = REVIEW_THRESHOLD,
    label: str = "label",
    pred: str = "pred",
    confidence: str = "confidence",
    order: str = "id",
) -> DataFrame:
    conf = F.col(confidence)
    return predictions.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count("*").alias("n"),
        F.count_if(conf >= F.lit(threshold)).alias("n_high"),
        F.avg(conf).alias("mean"),
        F.var_pop(conf).alias("variance"),
        F.min(conf).alias("least"),
        F.max(conf).alias("most"),
        F.min(order).alias("first_seen"),
    )


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def _centred(counts: DataFrame, *by: str) -> DataFrame:
    group = Window.partitionBy(*by)
    centre = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    return counts.withColumn("_centre", centre)


def _pooled_columns() -> list[Column]:
    gap = F.col("mean") - F.col("_centre")
    variance = F.sum(F.col("n") * (F.col("variance") + gap * gap)) / F.sum("n")
    return [F.max("_centre").alias("mean_confidence"), F.sqrt(variance).alias("std_confidence")]


def pooled(counts: DataFrame, *by: str) -> DataFrame:
    """Count, mean and population deviation of confidence over tally rows."""
    return _centred(counts, *by).groupBy(*by).agg(F.sum("n").alias("n"), *_pooled_columns())


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """``(label, pred, count, share)`` for every pair of classes seen on either
    side; ``share`` is of the true class, NULL where it has no rows."""
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("label", "pred")))))
    grid = (
        counts.agg(seen.alias("classes"))
        .select("classes", F.explode("classes").alias("label"))
        .select("label", F.explode("classes").alias("pred"))
    )
    cells = counts.select("label", "pred", "n")
    filled = grid.join(F.broadcast(cells), ["label", "pred"], "left").select(
        "label", "pred", F.coalesce("n", F.lit(0)).alias("count")
    )
    row_total = F.sum("count").over(Window.partitionBy("label"))
    return filled.withColumn(
        "share", F.when(row_total > 0, F.col("count").cast("double") / row_total)
    )


def confusion_wide(matrix: DataFrame, classes: list[int], value: str = "count") -> DataFrame:
    """The matrix with one column ``pred_{class}`` per predicted class."""
    wide = matrix.groupBy("label").pivot("pred", classes).agg(F.first(value))
    return wide.select("label", *[F.col(f"`{c}`").alias(f"pred_{c}") for c in classes])


def per_class(counts: DataFrame) -> DataFrame:
    """Support, predicted, hits, precision, recall and F1 of each class seen."""
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("label"),
                    F.col("n").alias("support"),
                    zero.alias("predicted"),
                    hit.cast("long").alias("hits"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    zero.alias("support"),
                    F.col("n").alias("predicted"),
                    zero.alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]
    )
    return sums.withColumns({
        "precision": ratio(F.col("hits"), F.col("predicted")),
        "recall": ratio(F.col("hits"), F.col("support")),
        "f1": ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")),
    })


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.sum("support")


def agreement_metrics(classes: DataFrame) -> DataFrame:
    """One row of accuracy, F1, precision, recall, kappa and correlation from
    ``per_class``. Kappa is NULL where chance agreement is certain; correlation
    is 0 where either side has one class only."""
    total = F.sum("support").cast("double")
    hits = F.sum("hits").cast("double")
    support, predicted = F.col("support").cast("double"), F.col("predicted").cast("double")
    base = classes.agg(
        total.alias("n"),
        (hits / total).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        _weighted("f1").alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        (hits / total).alias("f1_micro"),
        _weighted("precision").alias("precision_weighted"),
        F.avg("precision").alias("precision_macro"),
        _weighted("recall").alias("recall_weighted"),
        F.avg("recall").alias("recall_macro"),
        hits.alias("_hits"),
        F.sum(support * predicted).alias("_cross"),
        F.sum(support * support).alias("_true2"),
        F.sum(predicted * predicted).alias("_pred2"),
    )
    n, hit, cross = F.col("n"), F.col("_hits"), F.col("_cross")
    excess = n * hit - cross
    room = n * n - cross
    norm = F.sqrt((n * n - F.col("_true2")) * (n * n - F.col("_pred2")))
    return base.withColumns({
        "cohen_kappa": F.when(room != 0, excess / room),
        "matthews_corrcoef": ratio(excess, norm),
    }).drop("n", "_hits", "_cross", "_true2", "_pred2")


def classification_report(classes: DataFrame, label_map: DataFrame | None = None) -> DataFrame:
    """Per-class rows in label order, then accuracy, macro and weighted rows."""
    scores = ("precision", "recall", "f1")
    named = classes
    if label_map is not None:
        named = classes.join(F.broadcast(label_map), "label", "left")
    name = F.col("category") if label_map is not None else F.col("label").cast("string")
    rows = named.select(
        F.col("label").cast("int").alias("row_no"), name.alias("name"), *scores, "support"
    )

    def summary(place: int, title: str, values: dict[str, Column]) -> DataFrame:
        return classes.agg(
            F.lit(1_000_000 + place).alias("row_no"),
            F.lit(title).alias("name"),
            *[values.get(s, F.lit(None).cast("double")).alias(s) for s in scores],
            F.sum("support").alias("support"),
        )

    accuracy = F.sum("hits").cast("double") / F.sum("support")
    return (
        rows.unionByName(summary(1, "accuracy", {"f1": accuracy}))
        .unionByName(summary(2, "macro avg", {s: F.avg(s) for s in scores}))
        .unionByName(summary(3, "weighted avg", {s: _weighted(s) for s in scores}))
        .orderBy("row_no")
    )


def confidence_summary(counts: DataFrame) -> DataFrame:
    """One row: mean and deviation of confidence, and counts, rate and accuracy
    on either side of the tally's threshold (NULL on an empty side)."""
    right = F.col("label") == F.col("pred")
    low = F.col("n") - F.col("n_high")
    total, high_n, low_n = F.sum("n"), F.sum("n_high"), F.sum(low)
    return _centred(counts).agg(
        total.alias("n"),
        *_pooled_columns(),
        high_n.alias("n_high_confidence"),
        low_n.alias("n_low_confidence"),
        (high_n / total).alias("high_confidence_rate"),
        F.when(high_n > 0, F.sum(F.when(right, F.col("n_high")).otherwise(0)) / high_n).alias(
            "accuracy_high_confidence"
        ),
        F.when(low_n > 0, F.sum(F.when(right, low).otherwise(0)) / low_n).alias(
            "accuracy_low_confidence"
        ),
        low_n.alias("n_uncategorized"),
        (low_n * F.lit(100.0) / total).alias("uncategorized_percentage"),
    )
