"""Cleaning several columns of a frame, and counting what cleaning did."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def clean_columns(
    df: DataFrame,
    columns: Sequence[str],
    min_length: int = 10,
    max_length: int = 2000,
    redact_pii: bool = True,
) -> DataFrame:
    """Add ``{column}_clean`` for each column present; one that already has a
    cleaned form keeps it."""
    new = {
        f"{c}_clean": text.clean(c, min_length, max_length, redact_pii)
        for c in columns
        if c in df.columns and f"{c}_clean" not in df.columns
    }
    return df.withColumns(new) if new else df


def clean_fields(df: DataFrame, min_length: int = 10, max_length: int = 2000) -> DataFrame:
    """Training form: title and description cleaned apart, then joined."""
    out = clean_columns(df, ["title", "description"], min_length, max_length)
    if "text_clean" not in out.columns:
        out = out.withColumn(
            "text_clean", F.concat("title_clean", F.lit(" "), "description_clean")
        )
    return out


def clean_joined(df: DataFrame, min_length: int = 10, max_length: int = 2000) -> DataFrame:
    """Scoring form: title and description joined, then cleaned."""
    joined = F.concat(
        text.text_or_empty("title"), F.lit(" "), text.text_or_empty("description")
    )
    return df.withColumn("text_clean", text.clean(joined, min_length, max_length))


def _staged(df: DataFrame, columns: Sequence[str], redact_pii: bool) -> DataFrame:
    """One row per input row: per column (by its place) whether it is given, its
    text after cleaning, short of the length gate, and the personal-data hits of
    each pattern on the text it saw.

    A pattern is only replaced where it was counted. Every stage is a column of
    its own that the next names several times, which keeps Catalyst from
    inlining and repeating the stages.
    """
    stage = df.select(
        *[F.col(c).isNotNull().alias(f"given_{i}") for i, c in enumerate(columns)],
        *[text.strip_non_printable(c).alias(f"text_{i}") for i, c in enumerate(columns)],
    )
    places = range(len(columns))
    if redact_pii:
        for kind, pattern, token, needs in text.personal_data_steps():
            hits = {
                f"hits_{kind}_{i}": F.when(
                    needs(F.col(f"text_{i}")), F.regexp_count(f"text_{i}", F.lit(pattern))
                ).otherwise(0)
                for i in places
            }
            replaced = {
                f"text_{i}": F.when(
                    F.col(f"hits_{kind}_{i}") > 0,
                    F.regexp_replace(f"text_{i}", F.lit(pattern), F.lit(token)),
                ).otherwise(F.col(f"text_{i}"))
                for i in places
            }
            stage = stage.withColumns(hits).withColumns(replaced)
    return stage.withColumns({f"text_{i}": text.normalize(f"text_{i}") for i in places})


def cleaning_counters(
    df: DataFrame,
    columns: Sequence[str],
    min_length: int = 10,
    max_length: int = 2000,
    redact_pii: bool = True,
) -> DataFrame:
    """Tidy counters ``(column, counter, n)`` for each column present: rows
    processed, too short, too long, truncated, empty, and hits per kind of
    personal data with their total."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of {list(columns)} is a column of the frame")
    counts = {}
    for i in range(len(present)):
        content, given = F.col(f"text_{i}"), F.col(f"given_{i}")
        size = F.length(content)
        counts[i] = {
            "total_processed": F.count_if(given),
            "too_short": F.count_if(given & (size < min_length)),
            "too_long": F.count_if(given & (size > max_length)),
            "truncated": F.count_if(given & (size > max_length)),
            "empty_after_cleaning": F.count_if(
                given & (size >= min_length) & (F.trim(content) == "")
            ),
        }
        if redact_pii:
            hits = {f"pii_{k}": F.sum(F.col(f"hits_{k}_{i}").cast("long")) for k in text.KINDS}
            counts[i] |= {k: F.coalesce(v, F.lit(0)) for k, v in hits.items()}
    # All columns in one scan and one aggregate.
    row = _staged(df, present, redact_pii).agg(
        *[v.alias(f"{k}_{i}") for i, own in counts.items() for k, v in own.items()]
    )
    cells = [(c, k, F.col(f"{k}_{i}")) for i, c in enumerate(present) for k in counts[i]]
    if redact_pii:
        for i, c in enumerate(present):
            total = sum((F.col(f"pii_{k}_{i}") for k in text.KINDS), F.lit(0))
            cells.append((c, "pii_total", total))
    return row.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(c).alias("column"), F.lit(k).alias("counter"), n.cast("long").alias("n")
                )
                for c, k, n in cells
            ])
        )
    )
