"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chat, collocations, jaccard, language_model, mixing, packing, parsing, quality_classifier,
    quality_rules, sharding, toxicity, trie,
)
from .common import crc_of_id, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark, sf):
    rows = quality_rules.apply_rules(table(spark, sf, "documents"))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("stats.words").alias("n_words"),
        F.col("stats.word_chars").alias("word_chars"),
        F.col("stats.symbols").alias("n_symbols"),
        F.col("stats.dup_lines").alias("n_dup_lines"),
        F.col("stats.repeat_words").alias("n_repeat_words"),
        F.col("failed").alias("base_failed"),
        "kept",
        F.round("distance", 3).alias("distance"),
    )


@query
def op2_language_model(spark, sf):
    return language_model.score_documents(table(spark, sf, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_bpe(spark, sf):
    return bpe.encode_documents(table(spark, sf, "documents"), tokenizer_path(), digests=True)


@query
def op4_jaccard(spark, sf):
    return jaccard.linked_documents(table(spark, sf, "documents"))


def held_out(folds: int, remainder: int):
    return F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == remainder


@query
def op5_quality_classifier(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    scored = quality_classifier.score_documents(table(spark, sf, "documents"), labels)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


@query
def op6_fingerprints(spark, sf):
    return parsing.fingerprint_documents(table(spark, sf, "documents"))


@query
def op7_mixing(spark, sf):
    return mixing.mixed(table(spark, sf, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query
def op8_sharding(spark, sf):
    return sharding.shard_documents(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_chat(spark, sf):
    added = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf, "conversations").select(*added.columns).unionByName(added)
    read = chat.read_back(chat.format_chats(rows))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    parts = F.struct(
        "window", turns.alias("turns"), F.size("turns").alias("n_turns"),
        F.array_join("targets", "").alias("targets"), F.length("formatted").alias("chars"),
    )
    # A digest of a conversation needs it in one place; windows stay apart.
    per_conv = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(parts)).alias("w"),
        F.sum(F.size("turns")).cast("long").alias("n_turns"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    loss = F.array_join(F.col("w.targets"), "")
    return per_conv.select(
        "conv_id", "n_turns", digest(F.array_join(F.col("w.turns"), "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), digest(loss).alias("loss_sha256"),
        "formatted_chars", "n_windows",
    )


@query
def op10_toxicity(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    scored = toxicity.score_documents(table(spark, sf, "documents"), labels)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", "evidence")


@query
def op11_prefix_trie(spark, sf):
    return trie.rebuilt_trie(table(spark, sf, "conversations"))


@query
def op12_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


@query
def op13_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))
