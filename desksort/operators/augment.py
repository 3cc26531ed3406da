"""Adding synthetic tickets to the training split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import drop_duplicate_rows, row_key


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names both frames have, in the left frame's order."""
    also = set(right.columns)
    return [c for c in left.columns if c in also]


def add_synthetic(
    train: DataFrame,
    synthetic: DataFrame,
    order: str = "ordinal",
    text_columns: Sequence[str] = ("title", "description"),
    train_is_unique: bool = False,
) -> DataFrame:
    """Train rows then synthetic rows, on their common columns plus
    ``is_synthetic``, without rows whose texts came earlier. Original rows
    come before synthetic ones, so an original always survives.

    With ``train_is_unique`` (no two train rows have equal texts) no train row
    is shuffled: only the keys of train texts are, and not even those where the
    synthetic keys are few enough for Spark to broadcast.
    """
    shared = common_columns(train, synthetic)
    if order not in shared:
        raise ValueError(f"both frames need the order column {order!r}")
    first, then = train.select(*shared), synthetic.select(*shared)
    if not train_is_unique:
        first = drop_duplicate_rows(first, text_columns, order, "first")
    then = drop_duplicate_rows(then, text_columns, order, "first")
    key = row_key(text_columns).alias("_key")
    taken = first.select(key).join(then.select(key), "_key", "left_semi")
    new = then.withColumn("_key", key).join(taken, "_key", "left_anti").drop("_key")
    return first.withColumn("is_synthetic", F.lit(False)).unionByName(
        new.withColumn("is_synthetic", F.lit(True))
    )
