"""Exact quantiles that never gather or sort a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import joined, materialize

BITS = 16  # of a key's 64, that a count decides at least
FRACTION = 52  # bits of a double behind its exponent
NOT_A_NUMBER = 0x7FF8 << 48


def order_key(x: Column) -> Column:
    """A double as a long that sorts as it does: its bits, negated below zero.

    Exponent and fraction are taken apart by exact steps, as powers of two only move
    the exponent. Both zeros have one key, and all that is no number has the highest.
    """
    plain = ~F.isnan(x) & (F.abs(x) < float("inf")) & (x != 0)
    size = F.when(plain, F.abs(x)).otherwise(1.0)
    # The logarithm may be off by one beside a power of two.
    near = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)).cast("int")))
    power = lambda e: F.pow(F.lit(2.0), e)
    low = F.when((size < power(near)) & (near > -1022), near - 1).otherwise(near)
    exponent = F.when((size / power(low) >= 2) & (low < 1023), low + 1).otherwise(low)
    # In two steps, as 2 to the 1022 times 2 to the 52 is no double.
    fraction = (size / power(exponent) * float(1 << FRACTION)).cast("long")
    bits = (exponent + 1022).cast("long") * F.lit(1 << FRACTION) + fraction
    key = F.when(plain, bits).when(x == 0, F.lit(0)).otherwise(F.lit(0x7FF << FRACTION))
    return F.when(F.isnan(x), F.lit(NOT_A_NUMBER)).when(x < 0, -key).otherwise(key).cast("long")


def _counted(rows: DataFrame, groups: list, bucket: Column) -> DataFrame:
    """Rows per bucket, with its least and greatest key. Tasks add up first."""
    return rows.groupBy(*groups, bucket.alias("_bucket")).agg(
        F.count("*").alias("_n"), F.min("_k").alias("_low"), F.max("_k").alias("_high"), F.min("_x").alias("_value")
    )


def _holding(buckets: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Per group, the buckets that hold a wanted rank, as an array."""
    cell = F.struct("_low", "_high", "_below", "_n", "_value")
    return (
        joined(buckets, wanted.select(*by, "_wanted"), by)
        .where(F.exists("_wanted", lambda w: _holds(w["first"], F.col("_below"), F.col("_n"))
                        | _holds(w["last"], F.col("_below"), F.col("_n"))))
        .groupBy(*by)
        .agg(F.collect_list(cell).alias("_cells"))
    )


def _holds(rank: Column, below: Column, n: Column) -> Column:
    return (rank >= below) & (rank < below + n)


def exact_quantiles(
    df: DataFrame, column: str, quantiles: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation quantiles per group: ``(*by, quantile, value)``.

    A quantile lies between the values at one or two ranks. Rows are counted by the
    first bits of their value's key; the few buckets that hold a rank are counted
    again, each by ``BITS`` more bits of the range that it fills, or by value where it
    has no more rows than that makes buckets, until every one holds a single value.
    That takes at most four counts for any values, two or three for most. All ranks of
    a group are found together: a row meets its group once.
    """
    given, by = list(by), [*by, "_all"]
    x = F.col(column).cast("double")
    rows = materialize(
        df.where(F.col(column).isNotNull())
        .select(*given, F.lit(0).alias("_all"), x.alias("_x"))
        .withColumn("_k", order_key(F.col("_x")))
    )
    first = materialize(_counted(rows, by, F.shiftright("_k", 64 - BITS)))
    sizes = first.groupBy(*by).agg(F.sum("_n").alias("_total"))

    def want(q: float) -> Column:
        place = F.lit(float(q)) * (F.col("_total") - 1)
        return F.struct(
            F.lit(float(q)).alias("quantile"), F.floor(place).alias("first"), F.ceil(place).alias("last"),
            (place - F.floor(place)).alias("part"),
        )

    wanted = materialize(sizes.select(*by, F.array(*[want(q) for q in quantiles]).alias("_wanted")))
    in_order = Window.partitionBy(*by).orderBy("_bucket")
    upto = F.sum("_n").over(in_order)
    state = materialize(_holding(first.withColumn("_below", upto - F.col("_n")), wanted, by))
    wide = lambda c: c["_low"] < c["_high"]
    while not (open_ := state.where(F.exists("_cells", wide))).isEmpty():
        inside = (
            joined(rows, open_.select(*by, F.filter("_cells", wide).alias("_cells")), by)
            .withColumn("_cell", F.get(F.filter("_cells", lambda c: F.col("_k").between(c["_low"], c["_high"])), F.lit(0)))
            .where(F.col("_cell").isNotNull())
            .select(*by, "_k", "_x", F.col("_cell._low").alias("_from"), F.col("_cell._high").alias("_to"),
                    F.col("_cell._below").alias("_start"), F.col("_cell._n").alias("_rows"))
        )
        # As many bits are left out as the cell's range has beyond BITS.
        beyond = f"CASE WHEN _rows <= {1 << BITS} THEN 0 ELSE greatest(0, length(bin(_to - _from)) - {BITS}) END"
        step = F.expr(f"shiftright(_k - _from, {beyond})")
        finer = _counted(inside, [*by, "_from", "_start"], step)
        within = Window.partitionBy(*by, "_from").orderBy("_bucket")
        finer = finer.withColumn("_below", F.col("_start") + F.sum("_n").over(within) - F.col("_n"))
        done = state.select(*by, F.inline(F.filter("_cells", lambda c: ~wide(c))))
        both = finer.select(*by, "_low", "_high", "_below", "_n", "_value").unionByName(done)
        state = materialize(_holding(both, wanted, by))

    def at(rank: Column) -> Column:
        return F.get(F.filter("_cells", lambda c: _holds(rank, c["_below"], c["_n"])), F.lit(0))["_value"]

    found = joined(wanted, state, by).select(*given, "_cells", F.explode("_wanted").alias("_w"))
    ends = found.select(
        *given, F.col("_w.quantile").alias("quantile"), F.col("_w.part").alias("_part"),
        at(F.col("_w.first")).alias("_a"), at(F.col("_w.last")).alias("_b"),
    )
    # Without the guard, equal infinities would give no number.
    between = F.when(F.col("_a") == F.col("_b"), 0.0).otherwise((F.col("_b") - F.col("_a")) * F.col("_part"))
    return ends.select(*given, "quantile", (F.col("_a") + between).alias("value"))
