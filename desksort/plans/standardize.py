"""From a raw ticket feed to the standard ticket table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import taxonomy
from ..functions import tickets as t
from ..functions.text import is_blank, text_or_empty
from ..sources.feeds import as_roles, detect_columns, read_ticket_csv


def standardize_tickets(
    feed: DataFrame,
    ordinal: str = "ordinal",
    roles: Mapping[str, str | None] | None = None,
    run_at: dt.datetime | None = None,
    fragments: Sequence[tuple[str, Sequence[str]]] = taxonomy.CATEGORY_FRAGMENTS,
    keywords: Mapping[str, Sequence[str]] = taxonomy.KEYWORDS,
    id_prefix: str = taxonomy.TICKET_ID_PREFIX,
    source: str = taxonomy.FEED_NAME,
) -> DataFrame:
    """Standard tickets, one per row that has a title or a description.

    ``ordinal`` is the row's place in the feed; skipped rows keep theirs, so
    ids have gaps. ``roles`` overrides the column detection. One narrow pass:
    nothing is shuffled.
    """
    found = roles or detect_columns([c for c in feed.columns if c != ordinal])
    raw = (
        as_roles(feed, found, ordinal)
        .withColumns({
            "_title": text_or_empty("title"),
            "_description": text_or_empty("description"),
        })
        .where(~(is_blank("_title") & is_blank("_description")))
    )
    title, description = t.cross_fill(F.col("_title"), F.col("_description"))
    named = raw.withColumns({
        # Keywords look at the text as it came, before empty fields are filled.
        "_lowered": F.lower(F.concat("_title", F.lit(" "), "_description")),
        "_original": F.when(F.col("category") != "", F.col("category")),
    })
    return named.select(
        ordinal,
        F.concat(F.lit(id_prefix), F.col(ordinal).cast("string")).alias("ticket_id"),
        title.alias("title"),
        description.alias("description"),
        t.map_category(F.col("_original"), F.col("_lowered"), fragments, keywords).alias("category"),
        t.normalize_priority(F.col("priority")).alias("priority"),
        F.lit(run_at).cast("timestamp").alias("created_at"),
        F.lit(taxonomy.CUSTOMER_EMAIL).alias("customer_email"),
        F.lit(taxonomy.CUSTOMER_NAME).alias("customer_name"),
        F.lit(source).alias("source"),
        F.col("_original").alias("original_category"),
    )


def standardize_csv(
    spark: SparkSession,
    path: str,
    max_rows: int | None = None,
    partitions: int | None = None,
    **options: object,
) -> DataFrame:
    rows = read_ticket_csv(spark, path, max_rows, partitions=partitions)
    return standardize_tickets(rows, **options)
