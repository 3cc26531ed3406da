"""Integer labels for categories, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def build_label_map(df: DataFrame, category: str = "category") -> DataFrame:
    """``(label, category)`` in alphabetical order of the categories present."""
    present = df.where(F.col(category).isNotNull()).select(F.col(category).alias("category"))
    return present.distinct().select(
        (F.row_number().over(Window.orderBy("category")) - 1).alias("label"), "category"
    )


def encode(df: DataFrame, label_map: DataFrame, category: str = "category", label: str = "label"):
    """Add the label of a category; NULL where the map lacks it. The map has
    one row per class and is broadcast."""
    lookup = label_map.select(F.col("category").alias(category), F.col("label").alias(label))
    return df.join(F.broadcast(lookup), category, "left")


def decode(df: DataFrame, label_map: DataFrame, label: str = "label", category: str = "category"):
    lookup = label_map.select(F.col("label").alias(label), F.col("category").alias(category))
    return df.join(F.broadcast(lookup), label, "left")


def categories_in_order(label_map: DataFrame) -> list[str]:
    """Class names in label order. One row per class reaches the driver."""
    return [r["category"] for r in label_map.orderBy("label").collect()]


def label_mapping_record(label_map: DataFrame) -> DataFrame:
    """The mapping as one nested row: both directions and the class count."""

    def as_map(key, value):
        pairs = F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v"))))
        return F.map_from_entries(pairs)

    category, label = F.col("category"), F.col("label")
    return label_map.agg(
        as_map(category, label).alias("label_to_id"),
        as_map(label.cast("string"), category).alias("id_to_category"),
        F.count("*").cast("int").alias("num_classes"),
    )
