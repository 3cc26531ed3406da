"""Ticket feeds and prepared splits as frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import taxonomy
from ..operators.ordinal import first_rows, with_file_ordinal

# Cell texts a feed uses for "no value".
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def read_ticket_csv(
    spark: SparkSession,
    path: str | list[str],
    max_rows: int | None = None,
    multi_line: bool = True,
    missing: Sequence[str] = MISSING_CELLS,
    ordinal: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """Rows of ticket CSVs, all columns text, numbered in file order.

    Descriptions may hold line breaks, so by default a file is one task's
    work; large feeds should come as many files, or with
    ``multi_line=False`` where no field holds a break. ``partitions`` deals
    the rows of few files out before costly text steps.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    numbered = with_file_ordinal(raw, ordinal)
    if max_rows is not None:
        numbered = first_rows(numbered, max_rows, ordinal)
    cells = [
        F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in raw.columns
    ]
    rows = numbered.select(*cells, ordinal)
    return rows.repartition(partitions, ordinal) if partitions else rows


def detect_columns(
    names: Sequence[str], roles: Mapping[str, Sequence[str]] = taxonomy.ROLE_NAMES
) -> dict[str, str | None]:
    """For each role the first column, in file order, whose lower-cased name
    contains any of the role's parts. One column may serve two roles."""
    return {
        role: next((n for n in names if any(p in n.lower() for p in parts)), None)
        for role, parts in roles.items()
    }


def as_roles(df: DataFrame, found: Mapping[str, str | None], *keep: str) -> DataFrame:
    """Columns renamed to their roles; a role without a column is NULL."""
    roles = [
        (F.lit(None).cast("string") if name is None else F.col(f"`{name}`").cast("string")).alias(r)
        for r, name in found.items()
    ]
    return df.select(*keep, *roles)


def read_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """One split of the prepared tickets; the others' files are not read."""
    return spark.read.parquet(f"{folder.rstrip('/')}/splits").where(F.col("split") == split)


def read_label_map(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/label_map")


def read_synthetic(spark: SparkSession, path: str, ordinal: str = "ordinal") -> DataFrame:
    """Synthetic tickets from Parquet or CSV, numbered in file order."""
    if path.rstrip("/").endswith(".csv"):
        return read_ticket_csv(spark, path, ordinal=ordinal)
    return with_file_ordinal(spark.read.parquet(path), ordinal)
