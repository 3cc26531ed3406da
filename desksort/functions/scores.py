"""Class scores held as an ``array<double>`` in label order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import taxonomy
from .text import bind

REVIEW_THRESHOLD = 0.6


def category_array(categories: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in categories])


def softmax(logits: Column) -> Column:
    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v)
        return bind(total, lambda t: F.transform(powers, lambda v: v / t))

    def powers(x: Column) -> Column:
        return bind(F.array_max(x), lambda m: F.transform(x, lambda v: F.exp(v - m)))

    return bind(logits, lambda x: bind(powers(x), shares))


def argmax(probabilities: Column) -> Column:
    """Zero-based position of the first greatest value."""
    return bind(
        probabilities, lambda p: (F.array_position(p, F.array_max(p)) - 1).cast("int")
    )


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def probability_map(categories: Column, probabilities: Column) -> Column:
    return F.map_from_arrays(categories, probabilities)


def top_k(probabilities: Column, categories: Column, k: int = 3) -> Column:
    """The k greatest, as ``array<struct<category, probability>>``; k is capped
    at the number of classes and ties keep label order."""
    ranked = F.array_sort(
        F.transform(
            probabilities,
            lambda p, i: F.struct((-p).alias("neg"), i.alias("label"), p.alias("probability")),
        )
    )
    return F.transform(
        F.slice(ranked, 1, k),
        lambda s: F.struct(
            F.element_at(categories, s["label"] + 1).alias("category"),
            s["probability"].alias("probability"),
        ),
    )


def is_confident(conf: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    return conf >= F.lit(threshold)


def needs_manual_review(conf: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    return conf < F.lit(threshold)


def category_or_uncategorized(
    category: Column, conf: Column, threshold: float = REVIEW_THRESHOLD
) -> Column:
    return F.when(conf < F.lit(threshold), F.lit(taxonomy.UNCATEGORIZED)).otherwise(category)
