"""Mix sources to target weights.

Words per source are summed, targets follow the sources' weights up to a cap,
and each document is repeated floor(rate) times, plus once more with the
fraction as probability, drawn from a hash of seed and id.

Defined cases: null and blank texts have size 0; null sources are one source,
the last by order; a source without words has rate 0 and its documents are not
taken; rows that repeat an id share its draw; a null id draws like the empty
text; no rows give no rows. Only the named columns are read, so extra columns
may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import joined
from .common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
LARGEST_RATE = 3.0
SEED = "mix-1"


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    largest_rate: float = LARGEST_RATE,
) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code point order (null last) take the weights in turn. A target
    is its weight's share of all words, but at most ``largest_rate`` times the
    source; what a cap cuts off goes to the others by weight until none is
    above. That ends where all uncapped targets are one level times their
    weight, and the capped sources are those that reach their cap at the lowest
    levels: running sums in that order find the level without a loop.

    The windows run over one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    cap = F.col("source_size") * F.lit(float(largest_rate))
    by_level = Window.orderBy("_fills_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    return (
        totals.withColumn("_weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_fills_at", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(every))
        # The level if this source and those after it were the uncapped ones.
        .withColumn(
            "_level",
            (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            / F.sum("_weight").over(after),
        )
        # It rises while sources below it are taken out, then falls.
        .withColumn("_level", F.max("_level").over(every))
        .select(
            "source",
            "source_size",
            F.least("_cap", F.col("_level") * F.col("_weight")).alias("target"),
        )
    )


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from a hash: 52 bits of an MD5 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(2**52))


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    largest_rate: float = LARGEST_RATE,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: row (all its columns), size, source_size,
    target, copies (how often the mix takes it).

    The join meets a table of one row per source, broadcast if counted to be
    small, and else repeated so that a large source's rows are dealt out.
    """
    sized = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    )
    # The sums read only the two columns they need.
    targets = stored(
        source_targets(sized.select("source", "size"), weights, largest_rate), "mix-targets"
    )
    # 0 / 0 is a source without words. A capped source has exactly the cap.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = draw(F.col(f"row.{doc_id}"), seed) < rate - F.floor(rate)
    return joined(sized, targets, ["source"], "left").select(
        "row", "size", "source_size", "target",
        (F.floor(rate) + more.cast("long")).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    repeated = mixed(docs, **settings).withColumn("copies", F.col("copies").cast("int"))
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    return repeated.select("row", F.explode(times)).select("row.*")
