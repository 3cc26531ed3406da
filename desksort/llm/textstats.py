"""Statistics of whole texts as column expressions; no Python, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, word_array

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8


def _window_hashes(words: Column) -> Column:
    """A hash of each window of 8 words, by doubling: 1, 2, 4, 8 words."""

    def doubled(hashes: Column, step: int) -> Column:
        left = F.slice(hashes, 1, F.size(hashes) - step)
        right = F.slice(hashes, step + 1, F.size(hashes) - step)
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    one = F.transform(words, lambda w: F.xxhash64(w))
    return bound(
        one, lambda a: bound(doubled(a, 1), lambda b: bound(doubled(b, 2), lambda c: doubled(c, 4)))
    )


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(z: Column) -> Column:
        def same(e, other):
            return F.coalesce(e["h"] == other["h"], F.lit(False))

        return F.filter(z, lambda e, k: same(e, F.get(z, k - 1)) | same(e, F.get(z, k + 1)))

    def total(p: Column) -> Column:
        ahead = F.transform(
            p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(ahead, F.lit(0), lambda a, x: a + x)

    starts = bound(placed, lambda z: F.sort_array(F.transform(twice(z), lambda e: e["i"])))
    return bound(starts, total)


def repeated_words(words: Column) -> Column:
    """Words in 8-word windows that the text holds twice or more, each word
    once. Windows are equal when their 64-bit hashes are. Most texts repeat
    nothing and stop at the count of distinct hashes."""
    found = bound(
        _window_hashes(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h)),
    )
    return F.when(F.size(words) <= WINDOW, 0).otherwise(found)


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """Add ``stats``, a struct of counts: words, word_chars, symbols, lines (those
    with a word), dup_lines, repeat_words, upper (capital letters), distinct_words."""
    has_word = r"[^\x20\x09-\x0D]"
    whole = F.coalesce(F.col(text), F.lit(""))
    # Split off in steps: each array is made once and then named often.
    return (
        df.withColumn("_text", whole)
        .withColumn("_words", word_array(F.col("_text")))
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(has_word)))
        .withColumn(
            "stats",
            F.struct(
                F.size("_words").cast("long").alias("words"),
                F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias(
                    "word_chars"
                ),
                F.length(F.regexp_replace("_text", SYMBOLS, "")).cast("long").alias("symbols"),
                F.size("_lines").cast("long").alias("lines"),
                (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("dup_lines"),
                repeated_words(F.col("_words")).cast("long").alias("repeat_words"),
                F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")).cast("long").alias("upper"),
                F.size(F.array_distinct("_words")).cast("long").alias("distinct_words"),
            ),
        )
        .drop("_text", "_words", "_lines")
    )
