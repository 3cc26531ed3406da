"""Connected components of links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """vertex, component (its smallest vertex) for all ends of ``links`` (a, b).

    Each round, a vertex takes the smallest label that a neighbour has newly got, then
    the label of its label, so labels travel twice as far each time. Minima are added
    up before they are shuffled; a vertex with many links meets its label in a
    join that Spark splits.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b")
    edges = stored(both.distinct(), "component-edges")
    labels = stored(
        edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "vertex"),
        "component-labels",
    )
    offers = labels.where("label <> vertex")
    while True:
        near = edges.join(offers.withColumnsRenamed({"vertex": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, F.col("vertex") == F.col("a"), "left").select(
            "vertex", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("vertex").alias("next"), F.col("label").alias("next_label"))
        moved = stored(
            nearer.join(jump, "next").select(
                "vertex", F.least("next", "next_label").alias("to"), F.col("label").alias("was")
            ),
            "component-labels",
        )
        labels = moved.select("vertex", F.col("to").alias("label"))
        offers = moved.where(F.col("to") != F.col("was")).select("vertex", F.col("to").alias("label"))
        if moved.where(F.col("to") != F.col("was")).isEmpty():
            return labels.withColumnRenamed("label", "component")
