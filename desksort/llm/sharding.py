"""Deal documents into shards by longest processing time.

Rows with equal texts form a group that stays together. Groups sorted by size
go, largest first, to the least loaded shard of a heap. Only the large groups
are placed one by one: a group below one in ``single_share`` of all bytes joins
one of ``bundles`` bundles by its hash, and a bundle is placed as one group. So
the heap sees at most ``single_share + bundles`` items however many documents
there are, and loads differ by about a bundle at most.

Defined cases: a null text has no bytes and groups with empty texts; equal
sizes are placed by key; rows that repeat id and text take slots one after the
other; no rows give no rows. Only the named columns are read, so extra columns
may have any names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

OVERHEAD = 16


def place(items: list[tuple[int, str]], shards: int) -> list[int]:
    """Longest processing time: the shard of each (size, key)."""
    heap = [(0, shard) for shard in range(shards)]
    out = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1])):
        load, shard = heapq.heappop(heap)
        out[i] = shard
        heapq.heappush(heap, (load + items[i][0], shard))
    return out


def group_key(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    doc_id: str = "doc_id",
    text: str = "text",
    single_share: int = 4000,
    bundles: int = 4096,
    ranges: int = 4096,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Slots count from 0 in each shard without gaps. They are dealt in ``ranges``
    ranges of a hash of the id: counts per shard and range give where a range
    begins, and rows are ranked only inside a range.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    facts = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            group_key(content).alias("key"),
        )
        .withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int"))
        .withColumn(
            "range", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(7)), F.lit(ranges)).cast("int")
        ),
        "shard-facts",
    )
    groups = facts.groupBy("key", "bundle").agg(F.sum("size").cast("long").alias("size"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    single = F.col("size") * single_share >= total
    items = (
        groups.select(
            F.when(single, F.col("key")).alias("key"),
            F.when(~single, F.col("bundle")).alias("bundle"),
            "size",
        )
        .groupBy("key", "bundle")
        .agg(F.sum("size").cast("long").alias("size"))
        .collect()  # at most single_share + bundles rows
    )
    shard_of = place([(r["size"], r["key"] or f"bundle {r['bundle']:08d}") for r in items], shards)
    singles = spark.createDataFrame(
        [(r["key"], s) for r, s in zip(items, shard_of) if r["key"]], "key string, single_shard int"
    )
    of_bundle = [0] * bundles
    for r, s in zip(items, shard_of):
        if not r["key"]:
            of_bundle[r["bundle"]] = s
    bundled = spark.createDataFrame(
        [(b, s) for b, s in enumerate(of_bundle)], "bundle int, bundle_shard int"
    )
    # Both tables are bounded by the two parameters.
    dealt = (
        facts.join(F.broadcast(singles), "key", "left")
        .join(F.broadcast(bundled), "bundle")
        .withColumn("shard", F.coalesce("single_shard", "bundle_shard"))
    )
    counts = dealt.groupBy("shard", "range").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "range").orderBy("doc_id", "key")
    return (
        dealt.withColumn("rank", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "range"])
        .select(
            "doc_id", "size", "text_crc32", "shard",
            (F.col("start") + F.col("rank")).cast("long").alias("slot"),
        )
    )
