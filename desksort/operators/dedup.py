"""Exact-duplicate removal with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(columns: Sequence[str]) -> Column:
    """A fixed-size key equal for equal values of ``columns``; NULLs are equal.

    Each value goes in with its length in front, so that ('ab', 'c') and
    ('a', 'bc') differ, and NULL differs from empty.
    """
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def duplicate_groups(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """One narrow row per distinct key: copies, first and last ``order``.

    Counts and extremes combine before the shuffle, so a key that holds a third
    of all rows sends one row per task.
    """
    return (
        df.select(row_key(columns).alias("key"), F.col(order).alias("_order"))
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("_order").alias("first"),
            F.max("_order").alias("last"),
        )
    )


def drop_duplicate_rows(
    df: DataFrame, columns: Sequence[str], order: str, keep: str | bool = "first"
) -> DataFrame:
    """Keep the first or last copy by ``order`` (unique per row), or with
    ``keep=False`` only rows that have no copy.

    The survivors' order values are found on keys alone; the rows then meet
    them in a semi join on the unique ``order``, which cannot be skewed.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    groups = duplicate_groups(df, columns, order)
    if keep is False:
        groups = groups.where(F.col("copies") == 1)
    survivor = "last" if keep == "last" else "first"
    return df.join(groups.select(F.col(survivor).alias(order)), order, "left_semi")


def duplicates_removed(
    df: DataFrame, columns: Sequence[str], order: str, keep: str | bool = "first"
) -> DataFrame:
    kept = F.count_if(F.col("copies") == 1) if keep is False else F.count("*")
    return duplicate_groups(df, columns, order).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("initial_count"),
        kept.alias("final_count"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - kept).alias("removed"),
    )
