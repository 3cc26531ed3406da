"""Ticket-shaped views of the test tables, once for Spark and once for DuckDB.

Every view is made from all rows of its tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from desksort import taxonomy

PHRASES = (
    "Cannot login, password reset fails",
    "Charged twice on invoice, please refund",
    "App crash and error after update",
    "Feature request: please add dark mode",
    "API webhook sync broken",
    "Very slow loading, timeout",
    "GDPR audit and privacy question",
    "How to configure sso",
    "Hello there",
    "Interest rates",
    "",
    None,
)
FEED_CATEGORIES = (
    "Hardware", "Access", "HR Support", "Internal Project", "Change Request",
    "Rapid Delivery", "Billing team", "Miscellaneous", "Security audit", "Timeouts", None,
)
PRIORITIES = ("High", "critical", "URGENT", "1", "normal", "2", "low", "3", "weird", None)
SNIPPETS = (
    "john.doe@example.com",
    "555-123-4567",
    "123-45-6789",
    "4111-1111-1111-1111",
    "10.0.0.1",
    "https://example.com/a?b=1",
    "ticket #ABC1234",
    "Invoice INV99887",
    "user ABCD1234",
    "ACCT 123456789",
    "please identify me",
    "(555) 123-4567",
    "&lt;b&gt;x&lt;/b&gt; &amp;lt; &#39; wow!!! what?? ...... ----- ___",
    "plain",
)
SYNTHETIC_CATEGORIES = (
    "Feature Requests", "Integration Issues", "Performance Problems",
    "Security & Compliance", "Not A Category",
)
ANSWERS = ("Bug / Defect Reports", "UNCERTAIN", " uncertain ", "Banana", None, " Feature Requests ")
PREDICTION_CLASSES = 10
CLASS_NAMES = tuple(sorted([*taxonomy.CATEGORIES, taxonomy.UNCATEGORIZED]))


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(values: Sequence[str | None], n: Column | str) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def pick_sql(values: Sequence[str | None], n: str) -> str:
    return f"([{', '.join(quoted(v) for v in values)}])[({n}) % {len(values)} + 1]"


# --- Spark ---------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by key when the scan has fewer splits than the cluster has
    cores (one big row group, files that cannot be split). A scan with enough
    splits is returned as it is, so large inputs pay no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents; few splits are dealt out to all cores for text work."""
    return spread(table(spark, sf, "documents").select("doc_id", "text", "source"), "doc_id")


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        F.col("doc_id").alias("ordinal"),
        pick(PHRASES, "doc_id").alias("title"),
        F.col("text").alias("description"),
        pick(FEED_CATEGORIES, "doc_id").alias("category"),
        pick(PRIORITIES, "doc_id").alias("priority"),
    )


def with_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat("text", F.lit(" "), pick(SNIPPETS, "doc_id"))
    return documents(spark, sf).select("doc_id", text.alias("text"))


def synthetic(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of the labelled documents' tickets, and all conversation turns."""
    copies = (
        documents(spark, sf)
        .join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
        .select(
            (-F.col("doc_id") - 1).alias("ordinal"),
            F.when(pick(PHRASES, "doc_id") != "", pick(PHRASES, "doc_id"))
            .otherwise(F.substring("text", 1, 100))
            .alias("title"),
            F.col("text").alias("description"),
            pick(SYNTHETIC_CATEGORIES, "doc_id").alias("category"),
        )
    )
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
        pick(PHRASES, "conv_id").alias("title"),
        F.col("text").alias("description"),
        pick(SYNTHETIC_CATEGORIES, "conv_id").alias("category"),
    )
    return copies.unionByName(turns)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Made-up class probabilities for every embedding, mostly right."""
    weight = lambda i: (
        (F.col("vec_id") * 31 + i * 17) % 23
        + 1
        + F.when(F.col("label") == i, 12).otherwise(0)
    ).cast("double")
    weights = F.array(*[weight(i) for i in range(PREDICTION_CLASSES)])
    total = F.aggregate("w", F.lit(0.0), lambda acc, v: acc + v)
    return (
        table(spark, sf, "embeddings")
        .select(F.col("vec_id").alias("id"), "label", weights.alias("w"))
        .select("id", "label", F.transform("w", lambda v: v / total).alias("probs"))
        .select(
            "id",
            "label",
            (F.array_position("probs", F.array_max("probs")) - 1).cast("int").alias("pred"),
            "probs",
            F.array_max("probs").alias("confidence"),
            F.concat(F.lit("vector "), F.col("id").cast("string")).alias("text_clean"),
        )
    )


def prediction_labels(spark: SparkSession) -> DataFrame:
    rows = F.posexplode(F.array(*[F.lit(c) for c in CLASS_NAMES])).alias("label", "category")
    return spark.range(1).select(rows)


def opinions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), pick(ANSWERS, "vec_id").alias("answer")
    )


def _ticket(*names: str) -> Column:
    fields = {"title": F.substring("text", 1, 60), "description": F.col("text"), "vip": F.lit(True)}
    return F.to_json(F.struct(*[fields[n].alias(n) for n in names]))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a JSON ticket; by its id one of seven forms, three broken."""
    whole, form = _ticket("title", "description"), F.col("doc_id") % 7
    value = (
        F.when(form == 0, _ticket("title"))
        .when(form == 1, F.expr("substring(whole, 1, length(whole) - 1)"))
        .when(form == 2, _ticket("title", "description", "vip"))
        .when(form == 3, F.concat(F.lit("["), "whole", F.lit("]")))
        .otherwise(F.col("whole"))
    )
    return documents(spark, sf).withColumn("whole", whole).select(F.col("doc_id").alias("id"), value.alias("value"))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Every document inside a free-form answer, in one of six forms."""
    whole, form = _ticket("title", "description"), F.col("doc_id") % 6
    content = (
        F.when(form == 0, F.concat(F.lit("Sure! "), whole, F.lit(" Bye")))
        .when(form == 1, _ticket("title"))
        .when(form == 2, F.translate("text", "{}", "()"))
        .when(form == 3, F.concat(F.lit("{"), F.translate(F.substring("text", 1, 60), "{}", "()"), F.lit("}")))
        .when(form == 4, F.concat(F.lit("Here:\n"), whole, F.lit("\n")))
        .otherwise(F.to_json(F.struct(F.lit("").alias("title"), F.col("text").alias("description"))))
    )
    return documents(spark, sf).select(
        F.col("doc_id").alias("id"), pick(SYNTHETIC_CATEGORIES, "doc_id").alias("category"), content.alias("content")
    )


def request_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The conversations' batches, some cut short, some with incomplete tickets."""
    form = F.col("conv_id") % 9
    return conversation_batches(spark, sf).withColumn(
        "value",
        F.when(form == 4, F.expr("substring(value, 1, length(value) - 2)"))
        .when(form == 7, F.replace("value", F.lit('"description"'), F.lit('"text"')))
        .otherwise(F.col("value")),
    )


def conversation_batches(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON batch of tickets per conversation."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    tickets = F.transform(
        turns, lambda t: F.struct(t["role"].alias("title"), t["text"].alias("description"))
    )
    return (
        table(spark, sf, "conversations")
        .groupBy("conv_id")
        .agg(F.to_json(F.struct(tickets.alias("tickets"))).alias("value"))
    )


# --- DuckDB --------------------------------------------------------------

FEED = f"""feed AS (
  SELECT doc_id AS ordinal, {pick_sql(PHRASES, 'doc_id')} AS title, text AS description,
         {pick_sql(FEED_CATEGORIES, 'doc_id')} AS category,
         {pick_sql(PRIORITIES, 'doc_id')} AS priority
  FROM documents)"""

PERSONAL = f"""personal AS (
  SELECT doc_id, text || ' ' || {pick_sql(SNIPPETS, 'doc_id')} AS text FROM documents)"""

SYNTHETIC = f"""synthetic AS (
  SELECT -doc_id - 1 AS ordinal,
         CASE WHEN {pick_sql(PHRASES, 'doc_id')} <> '' THEN {pick_sql(PHRASES, 'doc_id')}
              ELSE substring(text, 1, 100) END AS title,
         text AS description, {pick_sql(SYNTHETIC_CATEGORIES, 'doc_id')} AS category
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT conv_id * 1000 + turn, {pick_sql(PHRASES, 'conv_id')}, text,
         {pick_sql(SYNTHETIC_CATEGORIES, 'conv_id')}
  FROM conversations)"""

_WEIGHTS = ", ".join(
    f"cast((vec_id * 31 + {i * 17}) % 23 + 1 + CASE WHEN label = {i} THEN 12 ELSE 0 END AS double)"
    for i in range(PREDICTION_CLASSES)
)
PREDICTIONS = f"""preds AS (
  SELECT id, label, list_transform(w, lambda v: v / list_sum(w)) AS probs,
         list_position(w, list_max(w)) - 1 AS pred, list_max(w) / list_sum(w) AS confidence,
         'vector ' || id AS text_clean
  FROM (SELECT vec_id AS id, label, [{_WEIGHTS}] AS w FROM embeddings))"""

CLASSES = f"""classes AS (
  SELECT unnest(range({len(CLASS_NAMES)})) AS label,
         unnest([{', '.join(quoted(c) for c in CLASS_NAMES)}]) AS category)"""

OPINIONS = f"""opinions AS (
  SELECT vec_id AS id, {pick_sql(ANSWERS, 'vec_id')} AS answer FROM embeddings)"""

# What must come out of the payloads, without parsing any.
REQUEST_ROWS = """judged AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 7 IN (1, 3) THEN NULL ELSE substring(text, 1, 60) END AS title,
         CASE WHEN doc_id % 7 IN (0, 1, 3) THEN NULL ELSE text END AS description,
         CASE WHEN doc_id % 7 = 1 THEN 'invalid_json' WHEN doc_id % 7 IN (0, 3) THEN 'missing_field' END AS reason
  FROM documents)"""

RESPONSE_ROWS = f"""answers AS (
  SELECT doc_id AS id, {pick_sql(SYNTHETIC_CATEGORIES, 'doc_id')} AS category,
         substring(text, 1, 60) AS title, text AS description
  FROM documents WHERE doc_id % 6 IN (0, 4) AND text <> '')"""
