"""From standard tickets to cleaned, labelled train / validation / test data."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.augment import add_synthetic
from ..operators.cleaning import clean_fields
from ..operators.dedup import drop_duplicate_rows
from ..operators.labels import build_label_map, encode
from ..operators.outliers import keep_band, length_band
from ..operators.split import stratified_split
from ..session import materialize
from ..sinks.tables import write_record, write_splits

TEXTS = ("title", "description")
MIN_TEXT = 10


@dataclass(frozen=True)
class Prepared:
    """The outcome of ``preprocess``: ``splits`` holds every kept ticket with
    its ``split`` and ``is_synthetic``; ``stats`` is tidy (stat, split,
    category, n)."""

    splits: DataFrame
    label_map: DataFrame
    stats: DataFrame

    def write(self, folder: str, run_at: dt.datetime | None = None) -> None:
        write_splits(self.splits, self.label_map, folder)
        write_record(stats_record(self.stats, run_at), f"{folder.rstrip('/')}/preprocessing_stats")


def clean_unique(tickets: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Tickets without exact copies, cleaned, with ``combined_length``; short
    texts are still in."""
    unique = drop_duplicate_rows(tickets, TEXTS, ordinal, "first")
    return clean_fields(unique).withColumn("combined_length", F.length("text_clean"))


def long_enough(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("combined_length") >= MIN_TEXT)


def preprocess(
    tickets: DataFrame,
    synthetic: DataFrame | None = None,
    ordinal: str = "ordinal",
    ticket_id: str = "ticket_id",
    seed: int = 42,
    held_out: float = 0.3,
    test_share: float = 0.5,
) -> Prepared:
    """Deduplicate, clean, drop short and extreme texts, label, split, and add
    synthetic tickets to train.

    The cleaned tickets are written once, and the splits once; what lies
    between reads the cleaned table, only the columns it needs, and leaves
    tables of a few rows (length band, label map, cuts). The split itself moves
    no rows.
    """
    cleaned = materialize(clean_unique(tickets, ordinal))
    enough = long_enough(cleaned)
    band = materialize(length_band(enough, "combined_length"))
    kept = keep_band(enough, "combined_length", band)
    label_map = materialize(build_label_map(kept))
    labelled = encode(kept, label_map)
    split = stratified_split(labelled, "category", ticket_id, seed, held_out, test_share)
    original = split.withColumn("is_synthetic", F.lit(False))
    if synthetic is None:
        splits = materialize(original)
    else:
        extra = synthetic if "label" in synthetic.columns else encode(synthetic, label_map)
        extra = clean_fields(extra).withColumn("combined_length", F.length("text_clean"))
        train = add_synthetic(
            original.where(F.col("split") == "train").drop("split", "is_synthetic"),
            extra,
            ordinal,
            TEXTS,
            train_is_unique=True,
        ).withColumn("split", F.lit("train"))
        held = original.where(F.col("split") != "train")
        splits = materialize(held.unionByName(train, allowMissingColumns=True))
    return Prepared(splits, label_map, preprocessing_stats(tickets, cleaned, splits, synthetic))


def preprocessing_stats(
    tickets: DataFrame, cleaned: DataFrame, splits: DataFrame, synthetic: DataFrame | None
) -> DataFrame:
    """Rows in, kept and dropped at each step, rows per split and category, and
    texts that meet again in another split once cleaned.

    One narrow pass each over the cleaned table and the splits."""
    enough = F.col("combined_length") >= MIN_TEXT
    is_extra, in_train = F.col("is_synthetic"), F.col("split") == "train"
    steps = cleaned.agg(F.count("*").alias("unique"), F.count_if(enough).alias("enough"))
    parts = splits.agg(
        F.count_if(~is_extra).alias("original"),
        F.count_if(in_train & ~is_extra).alias("train_original"),
        F.count_if(is_extra).alias("added"),
    )
    leaks = leaked_texts(splits).agg(F.count_if(F.col("splits") > 1))
    row = steps.select(
        "*",
        tickets.agg(F.count("*")).scalar().alias("given"),
        parts.select(F.struct("*")).scalar().alias("p"),
        leaks.scalar().alias("leaks"),
    )
    counts = {
        "input_tickets": F.col("given"),
        "duplicates_removed": F.col("given") - F.col("unique"),
        "short_texts_removed": F.col("unique") - F.col("enough"),
        # All tickets inside the band are still there: originals outlive copies.
        "extreme_cases_removed": F.col("enough") - F.col("p.original"),
        "original_tickets": F.col("p.original"),
        "train_original_tickets": F.col("p.train_original"),
        "train_augmented_tickets": F.col("p.added"),
        "texts_in_several_splits": F.col("leaks"),
    }
    if synthetic is not None:
        row = row.withColumn("extra", synthetic.agg(F.count("*")).scalar())
        counts["synthetic_tickets"] = F.col("extra")
        counts["removed_augmentation_duplicates"] = F.col("extra") - F.col("p.added")
    none = F.lit(None).cast("string")
    totals = row.select(*[v.alias(k) for k, v in counts.items()])
    tidy = totals.unpivot([], totals.columns, "stat", "n").select(
        "stat", none.alias("split"), none.alias("category"), "n"
    )
    by_class = splits.groupBy("split", "category").agg(F.count("*").alias("n"))
    return tidy.unionByName(by_class.select(F.lit("tickets").alias("stat"), "split", "category", "n"))


def leaked_texts(splits: DataFrame) -> DataFrame:
    """One row per cleaned text with the number of splits it occurs in. The
    split goes into a bit mask, so copies combine before the shuffle."""
    bit = F.when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).otherwise(4)
    return (
        splits.groupBy(F.sha2("text_clean", 256).alias("key"))
        .agg(F.bit_or(bit).alias("mask"))
        .select("key", F.bit_count("mask").alias("splits"))
    )


def stats_record(stats: DataFrame, run_at: dt.datetime | None = None) -> DataFrame:
    """The tidy stats as one nested row: a map of counts, and per split the
    rows per category. Its input has a few rows per class."""
    plain = stats.where(F.col("split").isNull())
    by_split = (
        stats.where(F.col("stat") == "tickets")
        .groupBy("split")
        .agg(
            F.sum("n").alias("total"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("d"),
        )
    )
    whole = by_split.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "total")))).alias("m")
    )
    spread = by_split.agg(
        F.map_from_entries(F.collect_list(F.struct("split", "d"))).alias("m")
    )
    return plain.agg(
        F.lit(run_at).cast("timestamp").alias("timestamp"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("stat", "n")))).alias("counts"),
    ).select(
        "timestamp",
        "counts",
        whole.scalar().alias("split_totals"),
        spread.scalar().alias("category_distributions"),
    )
