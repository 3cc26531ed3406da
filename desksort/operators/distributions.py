"""The numbers behind a histogram and a box plot of confidences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def histogram(df: DataFrame, series: str, value: str, bins: int = 50) -> DataFrame:
    """Equal bins over each series' own range: ``(series, bin, low, high,
    count, density)``, empty bins included.

    A bin holds its low edge and not its high one, but for the last, which
    holds both. A series of one value gets a range of 1 around it.
    """
    points = df.where(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.col(value).cast("double").alias("x")
    )
    ends = points.groupBy("series").agg(
        F.min("x").alias("_min"), F.max("x").alias("_max"), F.count("*").alias("_n")
    )
    half = F.when(F.col("_min") == F.col("_max"), 0.5).otherwise(0.0)
    ranges = ends.select(
        "series", (F.col("_min") - half).alias("lo"), (F.col("_max") + half).alias("hi"), "_n"
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * F.col("width"))

    # Division can land a value on the wrong side of an edge: step by one.
    guess = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    placed = (
        points.join(ranges, "series")
        .withColumn("_g", guess)
        .withColumn(
            "bin",
            F.when(F.col("x") < edge(F.col("_g")), F.col("_g") - 1)
            .when(
                (F.col("x") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1
            )
            .otherwise(F.col("_g"))
            .cast("int"),
        )
    )
    counted = placed.groupBy("series", "bin").agg(F.count("*").alias("count"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["series", "bin"], "left").select(
        "series",
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("_n") * F.col("width"))).alias("density"),
    )


def box_plot(df: DataFrame, series: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the extreme points within ``reach`` quartile ranges
    of the box) and outlier count per series."""
    points = df.where(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.col(value).cast("double").alias("x")
    )
    marks = exact_quantiles(points, "x", [0.25, 0.5, 0.75], by=["series"])

    def at(q: float):
        return F.max(F.when(F.col("quantile") == q, F.col("value")))

    box = marks.groupBy("series").agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3")
    )
    step = (F.col("q3") - F.col("q1")) * reach
    near = (F.col("x") >= F.col("q1") - step) & (F.col("x") <= F.col("q3") + step)
    return (
        points.join(box, "series")
        .groupBy("series", "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(near, F.col("x"))), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(near, F.col("x"))), F.col("q3")).alias("whisker_high"),
            F.count_if(~near).alias("outliers"),
        )
    )
