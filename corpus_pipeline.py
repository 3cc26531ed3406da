"""The corpus pipeline: from raw documents to encoded training text.

Five stages, each on all rows that the one before kept, stored before the next:

1. ``quality_classifier`` drops documents with a quality score below 0.5;
2. ``quality_rules`` drops documents that fail the base rule or lie outside
   their language and source;
3. ``ngram_jaccard`` keeps, of each group of linked documents, the rows with the
   smallest id, and of rows that repeat it one; texts without words are in no
   group and all stay;
4. ``mixing`` repeats or drops documents so that sources meet target weights;
5. ``bpe`` encodes what is left: one row per row, with ids and decoded text as
   digests.

Stages 1 to 4 return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from desksort.llm import bpe, jaccard, mixing, quality_classifier, quality_rules
from desksort.llm.common import stored, table
from desksort.llm.queries import tokenizer_path

# Learned models have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_classifier.keep_good(docs, labels)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, tokenizer_path(), digests=True)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("quality_rules", drop_outliers),
    ("ngram_jaccard", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
