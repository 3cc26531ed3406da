"""Seeded, exactly stratified train / validation / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import joined, materialize


def shuffle_key(row_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(row_id).cast("string"), F.lit(""))))


def apportion(sizes: DataFrame, stratum: str, size: str, draws: str, out: str) -> DataFrame:
    """Share ``draws`` (the same on every row) over the strata in proportion to
    ``size`` by largest remainder; ties go to the first stratum by name.

    Whole-number arithmetic throughout; one row per stratum.
    """
    everything = Window.partitionBy()
    exact = F.col(size).cast("decimal(19,0)") * F.col(draws).cast("decimal(19,0)")
    total = F.sum(size).over(everything).cast("decimal(19,0)")
    shared = (
        sizes.withColumn("_exact", exact)
        .withColumn("_total", total)
        .withColumn("_rest", F.col("_exact") % F.col("_total"))
        .withColumn("_base", F.expr("_exact div _total"))
        .withColumn("_spare", F.col(draws) - F.sum("_base").over(everything))
        .withColumn("_turn", F.row_number().over(Window.orderBy(F.desc("_rest"), F.asc(stratum))))
    )
    extra = F.when(F.col("_turn") <= F.col("_spare"), 1).otherwise(0)
    return shared.withColumn(out, F.col("_base") + extra).drop(
        "_exact", "_total", "_rest", "_base", "_spare", "_turn"
    )


def split_quotas(
    sizes: DataFrame, stratum: str, size: str, held_out: float = 0.3, test_share: float = 0.5
) -> DataFrame:
    """Rows of each stratum for each split: ``(stratum, size, train, val, test)``.

    The held-out share is drawn first, then divided between validation and
    test; each draw rounds the smaller side up, as a whole and by stratum.
    """
    everything = Window.partitionBy()
    whole = F.sum(size).over(everything)
    out = sizes.withColumn("_train_n", whole - F.ceil(whole * F.lit(held_out)))
    out = apportion(out, stratum, size, "_train_n", "train")
    out = out.withColumn("_held", F.col(size) - F.col("train"))
    rest = F.sum("_held").over(everything)
    out = out.withColumn("_val_n", rest - F.ceil(rest * F.lit(test_share)))
    out = apportion(out, stratum, "_held", "_val_n", "val")
    return out.select(
        stratum,
        size,
        F.col("train").cast("long").alias("train"),
        F.col("val").cast("long").alias("val"),
        (F.col("_held") - F.col("val")).cast("long").alias("test"),
    )


def stratified_split(
    df: DataFrame,
    stratum: str,
    row_id: str,
    seed: int = 42,
    held_out: float = 0.3,
    test_share: float = 0.5,
    digits: int = 3,
    ranked: int = 10_000,
    out: str = "split",
) -> DataFrame:
    """Add ``split``: each stratum's rows in hashed order, test first, then
    validation, then train, in exactly the quota numbers.

    No row of ``df`` is shuffled or ranked. Rows are counted by stratum and the
    first ``digits`` hex digits of the hash; the slices that hold a cut are
    counted again by more digits until none has more than ``ranked`` rows, and in
    those the rows of each id are counted. Every row then compares itself with its
    stratum's two cuts, a table of one row per stratum. Where a cut falls among rows
    of one id, however many, the table is written once with the rows numbered, and
    the numbers decide: they are counted by task, so no task ranks the id's rows but
    those of a single split. Rows without a stratum are a stratum; a null id is an id.
    """
    key = shuffle_key(row_id, seed)
    keyed = df.select(
        F.col(stratum).alias("_stratum"), F.col(row_id).alias("_id"), key.alias("_key")
    ).withColumn("_slice", F.substring("_key", 1, digits))
    slices = keyed.groupBy("_stratum", "_slice").agg(F.count("*").alias("_n"))
    sizes = slices.groupBy("_stratum").agg(F.sum("_n").alias("_size"))
    quotas = split_quotas(sizes, "_stratum", "_size", held_out, test_share)

    in_order = Window.partitionBy("_stratum").orderBy("_slice")
    running = slices.withColumn("_upto", F.sum("_n").over(in_order))
    wanted = quotas.select(
        "_stratum",
        F.explode(
            F.create_map(F.lit("test"), "test", F.lit("held"), F.col("test") + F.col("val"))
        ).alias("_cut", "_rank"),
    )
    def holds(sums: DataFrame, rank: str) -> DataFrame:
        return sums.where(
            (F.col(rank) > F.col("_upto") - F.col("_n")) & (F.col(rank) <= F.col("_upto"))
        ).select(
            "_stratum", "_slice", "_cut", (F.col(rank) - F.col("_upto") + F.col("_n")).alias("_nth"), "_n"
        )

    holding = materialize(holds(joined(running, materialize(wanted), ["_stratum"]), "_rank"))
    depth = digits
    while depth < 32 and not holding.where(F.col("_n") > ranked).isEmpty():
        depth = min(32, depth + digits)
        finer = (
            joined(keyed, holding.drop("_n"), ["_stratum", "_slice"])
            .groupBy("_stratum", "_cut", "_nth", F.substring("_key", 1, depth).alias("_slice"))
            .agg(F.count("*").alias("_n"))
        )
        order = Window.partitionBy("_stratum", "_cut").orderBy("_slice")
        holding = materialize(holds(finer.withColumn("_upto", F.sum("_n").over(order)), "_nth"))
        keyed = keyed.withColumn("_slice", F.substring("_key", 1, depth))
    runs = (
        joined(keyed, holding, ["_stratum", "_slice"])
        .groupBy("_stratum", "_cut", "_nth", "_key", "_id")
        .agg(F.count("*").alias("_n"))
    )
    inside = Window.partitionBy("_stratum", "_cut").orderBy("_key", "_id")
    # The id that holds each cut, and how many of its rows are before the cut.
    cuts = materialize(
        runs.withColumn("_upto", F.sum("_n").over(inside))
        .where((F.col("_nth") <= F.col("_upto")) & (F.col("_nth") > F.col("_upto") - F.col("_n")))
        .withColumn("_nth", F.col("_nth") - F.col("_upto") + F.col("_n"))
        .select("_stratum", "_cut", "_key", "_id", "_nth", "_n")
    )
    among = cuts.where(F.col("_nth") < F.col("_n"))
    rows, number = df, F.lit(0).cast("long")
    last = cuts.withColumn("_last", F.lit(0).cast("long"))
    if not among.isEmpty():
        rows = materialize(df.withColumn("_number", F.monotonically_increasing_id()))
        number = F.col("_number")
        last = last.withColumn("_last", F.lit(2**63 - 1)).where(F.col("_nth") == F.col("_n")).unionByName(
            _numbers_at(rows, among, stratum, row_id, key)
        )
    by_stratum = last.groupBy("_stratum").agg(*[
        F.max(F.when(F.col("_cut") == cut, F.struct("_key", "_id", "_last"))).alias(f"_{cut}_cut")
        for cut in ("test", "held")
    ])
    here = F.struct(key.alias("_key"), F.col(row_id).alias("_id"), number.alias("_last"))
    return (
        joined(rows, materialize(by_stratum.withColumnRenamed("_stratum", stratum)), [stratum], "left")
        .withColumn(
            out,
            F.when(here <= F.col("_test_cut"), F.lit("test"))
            .when(here <= F.col("_held_cut"), F.lit("val"))
            .otherwise(F.lit("train")),
        )
        .drop("_test_cut", "_held_cut", "_number")
    )


def _numbers_at(rows: DataFrame, cuts: DataFrame, stratum: str, row_id: str, key: Column) -> DataFrame:
    """``cuts`` with ``_last``: the number of the cut id's ``_nth`` row. A number's
    high bits are the split that its row was in: rows are counted by split, and only
    those of the split that holds the cut are ranked."""
    named = rows.select(
        F.col(stratum).alias("_stratum"), key.alias("_key"), F.col(row_id).alias("_id"), "_number",
        F.shiftright("_number", 33).alias("_part"),
    )
    cut = ["_stratum", "_cut", "_key", "_id", "_nth", "_n"]
    own = joined(named, cuts.where(F.col("_cut") == "test"), ["_stratum", "_key", "_id"]).unionByName(
        joined(named, cuts.where(F.col("_cut") == "held"), ["_stratum", "_key", "_id"])
    )
    parts = own.groupBy(*cut, "_part").agg(F.count("*").alias("_rows"))
    in_order = Window.partitionBy("_stratum", "_cut").orderBy("_part")
    at = materialize(
        parts.withColumn("_before", F.sum("_rows").over(in_order) - F.col("_rows"))
        .where((F.col("_nth") > F.col("_before")) & (F.col("_nth") <= F.col("_before") + F.col("_rows")))
        .select("_stratum", "_cut", "_part", "_before")
    )
    by_number = Window.partitionBy("_stratum", "_cut").orderBy("_number")
    return (
        joined(own, at, ["_stratum", "_cut", "_part"])
        .withColumn("_turn", F.row_number().over(by_number) + F.col("_before"))
        .where(F.col("_turn") == F.col("_nth"))
        .select(*cut, F.col("_number").alias("_last"))
    )
