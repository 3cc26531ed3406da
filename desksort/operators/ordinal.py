"""Row positions in file order, without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import joined, materialize


def with_file_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows of a file scan from 0, by file path and place in file.

    Rows are counted per input split; a running total over the splits gives
    each one its offset. Only that table, one row per split and so no longer
    than the split list the driver already holds, is summed in one task; it is
    broadcast if counted to be small, and the rows themselves then do not move.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = tagged.groupBy("_path", "_start").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_path",
        "_start",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        joined(tagged, materialize(offsets), ["_path", "_start"])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_path", "_start", "_at", "_shift")
    )


def first_rows(df: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    return df.where(F.col(ordinal) < n)
