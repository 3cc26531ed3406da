"""Tables and one-row records on disk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import taxonomy
from ..operators.labels import label_mapping_record


def write_tickets(tickets: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = tickets.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.save(path)


def write_splits(splits: DataFrame, label_map: DataFrame, folder: str) -> None:
    """Splits partitioned by ``split`` (synthetic rows told by
    ``is_synthetic``), the label map as a table and as JSON."""
    folder = folder.rstrip("/")
    splits.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/splits")
    label_map.write.mode("overwrite").parquet(f"{folder}/label_map")
    write_record(label_mapping_record(label_map), f"{folder}/label_mapping")


def write_record(record: DataFrame, path: str) -> None:
    """A small record as JSON lines in one file."""
    record.coalesce(1).write.mode("overwrite").json(path)


def dataset_record(
    tickets: DataFrame,
    dataset_name: str,
    source: str = taxonomy.FEED_NAME,
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """What a standardised table holds, as one nested row.

    One scan: grouping sets give the rows per category, per priority and in all,
    and a few rows per value are put together. Null values are in no distribution."""
    columns = ("category", "priority")
    sized = tickets.select(
        *columns, F.length("title").alias("_title"), F.length("description").alias("_description")
    )
    each = [[F.col(c)] for c in columns]
    grouped = sized.groupingSets([*each, []], *columns).agg(
        F.grouping_id(*columns).alias("_set"), F.count("*").alias("_n"),
        F.avg("_title").alias("_title"), F.avg("_description").alias("_description"),
    )
    # In a set's number, a bit is 0 for the column that is grouped by.
    in_all, by = (1 << len(columns)) - 1, {c: (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - i)) for i, c in enumerate(columns)}

    def distribution(column: str):
        here = (F.col("_set") == by[column]) & F.col(column).isNotNull()
        pairs = F.array_sort(F.collect_list(F.when(here, F.struct(F.col(column).alias("k"), F.col("_n").alias("v")))))
        return F.map_from_entries(pairs).alias(f"{column}_distribution")

    def total(column: str):
        return F.max(F.when(F.col("_set") == in_all, F.col(column)))

    return grouped.agg(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(source).alias("source"),
        F.coalesce(total("_n"), F.lit(0).cast("long")).alias("total_tickets"),
        F.lit(run_at).cast("timestamp").alias("generation_date"),
        *[distribution(c) for c in columns],
        F.struct(
            total("_title").alias("avg_title_length"), total("_description").alias("avg_description_length")
        ).alias("statistics"),
    )
