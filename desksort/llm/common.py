"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_at_end, shared_folder

# Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: names an expression that a
    lambda inside ``body`` would otherwise compute anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several steps read to the shared folder and read it
    back: a lost executor then costs a re-read, not the frame's lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)



def frequent(counts: DataFrame, n: str, most: int) -> Column:
    """Whether a count belongs to the highest, of which there are ``most`` rows at
    most: counts are cut at a 64th of a power of two. Rows are counted per such
    step, so nothing is sorted and the driver gets a few thousand numbers."""
    step = F.floor(F.log2(F.col(n).cast("double")) * 64).cast("int")
    per_step = sorted(((r["step"], r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    cut, total = None, 0
    for at, rows in per_step:
        total += rows
        if total > most:
            break
        cut = at
    return step >= cut if cut is not None else F.lit(False)


FEW_IDS = 1_000_000


def only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``keys``, which are broadcast when counted to be few."""
    return rows.join(F.broadcast(keys) if keys.count() <= FEW_IDS else keys, key, "left_semi")


HEAVY = 10_000


def met(rows: DataFrame, table: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows``, which should be stored, beside the row of ``table`` with equal keys,
    or nulls where it has none. ``size`` says how many rows a key of ``table`` has.

    Keys of at least a ``HEAVY``th of all sizes, and so no more than ``HEAVY``, are
    broadcast; only rows of the other keys, few each, are shuffled."""
    total = table.agg(F.sum(size)).first()[0] or 0
    heavy = F.col(size) * HEAVY >= total
    others = [c for c in table.columns if c not in keys and c != size]
    small = table.drop(size) if size not in keys else table
    tall = table.where(heavy).select(*small.columns, F.lit(True).alias("_heavy"))
    tried = rows.join(F.broadcast(tall), keys, "left")
    rest = tried.where(F.col("_heavy").isNull()).drop("_heavy", *others)
    rest = rest.join(table.where(~heavy).select(*small.columns), keys, "left")
    return tried.where("_heavy").drop("_heavy").unionByName(rest)


def running(df: DataFrame, key: str, order: str, values: dict[str, str], how=F.sum, add=Column.__add__, span: int = 4096) -> DataFrame:
    """For each ``name: column`` of ``values``, the sum over the rows of the same key
    that come before, by ``order`` (long, 0 or more, without ties in a key). A key's
    rows are dealt out by ranges of ``span`` numbers, so none is in one task whole.
    ``how`` and ``add`` may be another sum of parts."""
    ranged = df.withColumn("_range", F.floor(F.col(order) / span))
    inside = Window.partitionBy(key, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(key, "_range").agg(*[how(c).alias(n) for n, c in values.items()])
    totals = totals.select(key, "_range", *[how(n).over(before).alias(f"_{n}") for n in values])
    rows = ranged.withColumns({n: F.coalesce(how(c).over(inside), F.lit(0)) for n, c in values.items()})
    rows = rows.join(totals.where(F.col("_range") > 0), [key, "_range"], "left")
    whole = {n: add(F.col(n), F.coalesce(f"_{n}", F.lit(0))) for n in values}
    return rows.withColumns(whole).drop("_range", *[f"_{n}" for n in values])
