"""Registered queries: every operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from desksort import taxonomy
from desksort.functions import scores, text, tickets
from desksort.operators import (
    augment, certificate, cleaning, dedup, distributions, errors, features, labels, outliers, profile,
    quantiles, routing, split, tally,
)
from desksort.operators.classifier import BatchScorer, TicketClassifier
from desksort.plans import evaluate as evaluation
from desksort.plans import preprocess as prep
from desksort.plans import reuse, score, train
from desksort.plans.standardize import standardize_csv, standardize_tickets
from desksort.session import materialize, scratch_path, ship_package
from desksort.sinks import json_output, tables
from desksort.sources import feeds, payloads
from desksort.streaming import tickets as streaming

from . import fixtures as fx
from .stop_words import STOP_WORDS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLD = 0.2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(*columns: str, digits: int = 9):
    """Round computed doubles, whose last bits depend on the order of sums."""

    def decorate(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            df = fn(spark, sf)
            return df.withColumns({c: F.round(c, digits) for c in columns})

        return run

    return decorate


# --- sources and standardising -------------------------------------------


def _csv_feed(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "feed")
    names = {"title": "Subject", "description": "Ticket Body", "category": "topic_group",
             "priority": "urgency_level"}
    named = fx.feed(spark, sf).withColumnsRenamed(names).orderBy("ordinal").drop("ordinal")
    (
        named.write.option("header", True).option("escape", '"').option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@query
def ticket_csv_scan(spark, sf):
    return feeds.read_ticket_csv(spark, _csv_feed(spark, sf)).withColumnsRenamed(
        {"Subject": "subject", "Ticket Body": "body"}
    )


@query
def ticket_csv_first_rows(spark, sf):
    return feeds.read_ticket_csv(spark, _csv_feed(spark, sf), max_rows=100).select(
        "ordinal", "topic_group"
    )


@query
def standardized_from_csv(spark, sf):
    return standardize_csv(
        spark, _csv_feed(spark, sf), partitions=spark.sparkContext.defaultParallelism
    ).drop("created_at")


@query
def standardized_tickets(spark, sf):
    return standardize_tickets(fx.feed(spark, sf)).drop("created_at")


@query
def keyword_categories(spark, sf):
    docs = fx.with_personal_data(spark, sf).withColumn("lowered", F.lower("text"))
    return docs.select("doc_id", tickets.keyword_category(F.col("lowered")).alias("category"))


@query
def fragment_categories(spark, sf):
    feed = fx.feed(spark, sf)
    return feed.select(
        "ordinal", tickets.fragment_category(F.col("category")).alias("mapped")
    )


@query
def priority_levels(spark, sf):
    feed = fx.feed(spark, sf)
    return feed.select("ordinal", tickets.normalize_priority(F.col("priority")).alias("priority"))


@query
def order_priority_levels(spark, sf):
    orders = fx.table(spark, sf, "orders")
    level = tickets.normalize_priority(F.substring_index("o_orderpriority", "-", 1))
    return profile.value_counts(orders.select(level.alias("priority")), "priority")


@query
def json_requests(spark, sf):
    return payloads.parse_tickets(fx.requests(spark, sf)).drop("value")


@query
def rejected_requests(spark, sf):
    parsed = payloads.parse_tickets(fx.requests(spark, sf))
    return payloads.rejected_tickets(parsed).groupBy("reason").agg(F.count("*").alias("n"))


@query
def response_tickets(spark, sf):
    return payloads.tickets_from_responses(fx.responses(spark, sf)).drop("content")


@query
def batch_request_tickets(spark, sf):
    parsed = payloads.parse_batches(fx.conversation_batches(spark, sf))
    return payloads.batch_tickets(parsed, "conv_id")


# --- cleaning ------------------------------------------------------------


def _per_document(make) -> Query:
    def run(spark, sf):
        return fx.with_personal_data(spark, sf).select("doc_id", make("text").alias("text"))

    return run


QUERIES["redacted_text"] = _per_document(text.redact)
QUERIES["redacted_contacts"] = _per_document(
    lambda c: text.redact(c, kinds=["email", "phone", "url"])
)
QUERIES["printable_text"] = _per_document(text.strip_non_printable)
QUERIES["quiet_text"] = _per_document(text.squeeze_noise)
QUERIES["normalized_text"] = _per_document(text.normalize)
QUERIES["collapsed_text"] = _per_document(text.collapse_whitespace)
QUERIES["length_gated_text"] = _per_document(lambda c: text.gate_length(c, 200, 1000))
QUERIES["cleaned_text"] = _per_document(text.clean)
QUERIES["cleaned_text_unredacted"] = _per_document(lambda c: text.clean(c, redact_pii=False))


@query
def page_text_without_markup(spark, sf):
    pages = fx.spread(fx.table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", text.strip_markup("html").alias("text"))


@query
def cleaned_pages(spark, sf):
    pages = fx.spread(fx.table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", text.clean("html").alias("text"))


@query
def cleaned_fields(spark, sf):
    out = cleaning.clean_fields(standardize_tickets(fx.feed(spark, sf)))
    return out.select("ordinal", "title_clean", "description_clean", "text_clean")


@query
def cleaned_joined(spark, sf):
    return cleaning.clean_joined(fx.feed(spark, sf)).select("ordinal", "text_clean")


@query
def cleaning_counters(spark, sf):
    feed = fx.feed(spark, sf).select("title", "description")
    return cleaning.cleaning_counters(feed, ["title", "description", "absent"])


@query
def personal_data_counts(spark, sf):
    counted = cleaning.cleaning_counters(fx.with_personal_data(spark, sf), ["text"])
    return counted.where(F.startswith("counter", F.lit("pii_"))).select("counter", "n")


# --- duplicates, lengths, labels, splits ---------------------------------


def _unique(keep) -> Query:
    def run(spark, sf):
        docs = fx.documents(spark, sf).select("doc_id", "text")
        return dedup.drop_duplicate_rows(docs, ["text"], "doc_id", keep)

    return run


QUERIES["unique_first"] = _unique("first")
QUERIES["unique_last"] = _unique("last")
QUERIES["unique_only"] = _unique(False)


@query
def duplicates_removed(spark, sf):
    turns = fx.table(spark, sf, "conversations").withColumn(
        "row", F.col("conv_id") * 1000 + F.col("turn")
    )
    return dedup.duplicates_removed(turns, ["role", "text"], "row")


@query
def long_enough_texts(spark, sf):
    return prep.long_enough(prep.clean_unique(fx.feed(spark, sf))).select(
        "ordinal", "combined_length"
    )


def _lengths(spark, sf):
    return fx.documents(spark, sf).select("doc_id", F.length("text").alias("length"))


@query
@rounded("min_threshold", "max_threshold")
def length_band(spark, sf):
    return outliers.length_band(_lengths(spark, sf), "length")


@query
def lengths_in_band(spark, sf):
    lengths = _lengths(spark, sf)
    return outliers.keep_band(lengths, "length", outliers.length_band(lengths, "length"))


@query
@rounded("min_threshold", "max_threshold")
def length_band_stats(spark, sf):
    lengths = _lengths(spark, sf)
    return outliers.band_stats(lengths, "length", outliers.length_band(lengths, "length"))


@query
@rounded("value")
def price_quantiles(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    return quantiles.exact_quantiles(
        items, "l_extendedprice", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], by=["l_returnflag"]
    )


@query
def written_tickets(spark, sf):
    folder = scratch_path(spark, "tickets")
    tables.write_tickets(standardize_tickets(fx.feed(spark, sf)), folder)
    return spark.read.parquet(folder).drop("created_at")


@query
def label_map(spark, sf):
    return labels.build_label_map(standardize_tickets(fx.feed(spark, sf)))


@query
def label_mapping_record(spark, sf):
    record = labels.label_mapping_record(
        labels.build_label_map(standardize_tickets(fx.feed(spark, sf)))
    )
    return record.select(
        F.explode("label_to_id").alias("category", "label"), "id_to_category", "num_classes"
    ).select(
        "category",
        "label",
        F.element_at("id_to_category", F.col("label").cast("string")).alias("back"),
        "num_classes",
    )


@query
def encoded_synthetic(spark, sf):
    known = labels.build_label_map(standardize_tickets(fx.feed(spark, sf)))
    return labels.encode(fx.synthetic(spark, sf), known).select("ordinal", "category", "label")


@query
def split_by_source(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "source")
    return split.stratified_split(docs, "source", "doc_id")


@query
def split_by_event_type(spark, sf):
    """Uneven strata, so that remainders are shared out."""
    events = fx.table(spark, sf, "events").select("event_id", "event_type")
    return split.stratified_split(events, "event_type", "event_id", seed=7, digits=1)


@query
def split_quotas(spark, sf):
    sizes = fx.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("size"))
    return split.split_quotas(sizes, "event_type", "size")


@query
def split_counts(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang")
    return profile.split_counts(split.stratified_split(docs, "lang", "doc_id"), "split", "lang")


@query
def augmented_train(spark, sf):
    tickets_ = standardize_tickets(fx.feed(spark, sf))
    both = augment.add_synthetic(tickets_, fx.synthetic(spark, sf))
    return both.select("ordinal", "title", "description", "category", "is_synthetic")


def _prepared(spark, sf) -> prep.Prepared:
    return prep.preprocess(standardize_tickets(fx.feed(spark, sf)), fx.synthetic(spark, sf))


@query
def preprocessed_tickets(spark, sf):
    return _prepared(spark, sf).splits.select(
        "ordinal", "title", "description", "text_clean", "combined_length", "category", "label",
        "split", "is_synthetic",
    )


@query
def preprocessing_stats(spark, sf):
    return _prepared(spark, sf).stats


@query
def leaked_texts(spark, sf):
    leaks = prep.leaked_texts(_prepared(spark, sf).splits)
    return leaks.groupBy("splits").agg(F.count("*").alias("texts"))


@query
def prepared_counts(spark, sf):
    folder = scratch_path(spark, "prepared")
    prep.preprocess(standardize_tickets(fx.feed(spark, sf))).write(folder)
    return reuse.prepared_counts(spark, folder)


# --- profiles ------------------------------------------------------------


@query
@rounded("percentage")
def category_counts(spark, sf):
    return profile.value_counts(standardize_tickets(fx.feed(spark, sf)), "category")


@query
@rounded("percentage")
def event_type_counts(spark, sf):
    return profile.value_counts(fx.table(spark, sf, "events"), "event_type")


@query
def mapping_summary(spark, sf):
    return profile.mapping_summary(standardize_tickets(fx.feed(spark, sf)))


@query
@rounded("mean_length")
def length_stats(spark, sf):
    return profile.length_stats(standardize_tickets(fx.feed(spark, sf)))


@query
def dataset_record(spark, sf):
    """The nested record, laid out as (part, key, value) rows."""
    record = tables.dataset_record(standardize_tickets(fx.feed(spark, sf)), "documents")

    def part(name: str, key, value):
        return record.select(
            F.lit(name).alias("part"), key.alias("key"),
            F.round(value.cast("double"), 9).alias("value"),
        )

    out = part("total", F.lit("tickets"), F.col("total_tickets"))
    for name in ("avg_title_length", "avg_description_length"):
        out = out.unionByName(part("mean", F.lit(name), F.col(f"statistics.{name}")))
    for name in ("category", "priority"):
        rows = record.select(F.explode(f"{name}_distribution").alias("key", "value")).select(
            F.lit(name).alias("part"), "key", F.col("value").cast("double").alias("value")
        )
        out = out.unionByName(rows)
    return out


@query
@rounded("weight")
def class_weights(spark, sf):
    return profile.class_weights(fx.table(spark, sf, "labels"), "quality")


# --- evaluation ----------------------------------------------------------


def _tally(spark, sf) -> DataFrame:
    return tally.tally(fx.predictions(spark, sf), THRESHOLD)


@query
@rounded("share")
def confusion_matrix(spark, sf):
    return tally.confusion_matrix(_tally(spark, sf))


@query
def confusion_matrix_wide(spark, sf):
    matrix = tally.confusion_matrix(_tally(spark, sf))
    return tally.confusion_wide(matrix, list(range(fx.PREDICTION_CLASSES)))


METRICS = (
    "accuracy", "balanced_accuracy", "f1_weighted", "f1_macro", "f1_micro",
    "precision_weighted", "precision_macro", "recall_weighted", "recall_macro",
    "cohen_kappa", "matthews_corrcoef",
)


@query
@rounded(*METRICS)
def agreement_metrics(spark, sf):
    return tally.agreement_metrics(tally.per_class(_tally(spark, sf)))


@query
@rounded("precision", "recall", "f1")
def classification_report(spark, sf):
    report = tally.classification_report(
        tally.per_class(_tally(spark, sf)), fx.prediction_labels(spark)
    )
    return report.drop("row_no")


CONFIDENCE = (
    "mean_confidence", "std_confidence", "high_confidence_rate", "accuracy_high_confidence",
    "accuracy_low_confidence", "uncategorized_percentage",
)


@query
@rounded(*CONFIDENCE)
def confidence_summary(spark, sf):
    return tally.confidence_summary(_tally(spark, sf))


@query
@rounded("value")
def median_confidence(spark, sf):
    return quantiles.exact_quantiles(fx.predictions(spark, sf), "confidence", [0.5])


@query
@rounded("error_rate")
def error_rate(spark, sf):
    return errors.error_rate(_tally(spark, sf))


@query
@rounded("error_rate")
def category_error_rates(spark, sf):
    return errors.category_error_rates(_tally(spark, sf), fx.prediction_labels(spark))


@query
@rounded("percentage")
def error_patterns(spark, sf):
    return errors.error_patterns(_tally(spark, sf), fx.prediction_labels(spark))


@query
@rounded("percentage")
def top_error_patterns(spark, sf):
    return errors.top_error_patterns(_tally(spark, sf), fx.prediction_labels(spark))


@query
@rounded("mean_confidence", "std_confidence")
def error_confidence(spark, sf):
    return errors.error_confidence(_tally(spark, sf))


@query
@rounded("confidence")
def confident_errors(spark, sf):
    return errors.confident_errors(fx.predictions(spark, sf), fx.prediction_labels(spark), 50)


@query
@rounded("low", "high", "density")
def confidence_histogram(spark, sf):
    series = evaluation.as_series(fx.predictions(spark, sf))
    return distributions.histogram(series, "series", "confidence")


@query
@rounded("q1", "median", "q3", "whisker_low", "whisker_high")
def confidence_box_plot(spark, sf):
    series = evaluation.as_series(fx.predictions(spark, sf))
    return distributions.box_plot(series, "series", "confidence")


@query
@rounded("q1", "median", "q3", "whisker_low", "whisker_high")
def event_value_box_plot(spark, sf):
    return distributions.box_plot(fx.table(spark, sf, "events"), "event_type", "value")


@query
@rounded("accuracy", "f1_weighted", "precision_weighted", "recall_weighted",
         "uncategorized_percentage")
def split_evaluation(spark, sf):
    return evaluation.split_evaluation(fx.predictions(spark, sf), "val", THRESHOLD)


@query
def evaluation_summary(spark, sf):
    results = evaluation.evaluate(
        fx.predictions(spark, sf), fx.prediction_labels(spark), THRESHOLD
    )
    return results["summary"]


@query
def evaluation_record(spark, sf):
    results = evaluation.evaluate(
        fx.predictions(spark, sf), fx.prediction_labels(spark), THRESHOLD
    )
    record = evaluation.evaluation_record(results, "test")
    return record.select(F.to_json(F.struct("*")).alias("record"))


# --- scores and routing --------------------------------------------------


def _records(spark, sf) -> DataFrame:
    """The made-up predictions as prediction records."""
    names = scores.category_array(fx.CLASS_NAMES)
    return fx.predictions(spark, sf).select(
        "id",
        F.element_at(names, F.col("pred") + 1).alias("predicted_category"),
        "confidence",
        scores.needs_manual_review(F.col("confidence"), THRESHOLD).alias("needs_manual_review"),
        F.lit("fixture").alias("model_type"),
        scores.probability_map(names, F.col("probs")).alias("all_probabilities"),
    )


@query
@rounded("confidence", digits=6)
def softmax_scores(spark, sf):
    logits = F.transform("embedding", lambda v: v.cast("double") * 10)
    probs = fx.table(spark, sf, "embeddings").select(
        "vec_id", scores.softmax(logits).alias("p")
    )
    return probs.select(
        "vec_id", scores.argmax(F.col("p")).alias("pred"),
        scores.confidence(F.col("p")).alias("confidence"),
    )


@query
@rounded("probability")
def class_probabilities(spark, sf):
    return _records(spark, sf).select(
        "id", F.explode("all_probabilities").alias("category", "probability")
    )


@query
@rounded("probability")
def top_classes(spark, sf):
    best = scores.top_k(F.col("probs"), scores.category_array(fx.CLASS_NAMES), 3)
    return fx.predictions(spark, sf).select("id", F.posexplode(best).alias("rank", "c")).select(
        "id", "rank", "c.category", "c.probability"
    )


@query
def review_flags(spark, sf):
    conf = F.col("confidence")
    return _records(spark, sf).select(
        "id",
        scores.is_confident(conf, THRESHOLD).alias("confident"),
        "needs_manual_review",
        scores.category_or_uncategorized(F.col("predicted_category"), conf, THRESHOLD).alias(
            "category"
        ),
    )


@query
def second_opinions(spark, sf):
    read = routing.read_answer(F.col("answer")).alias("o")
    return fx.opinions(spark, sf).select("id", read).select(
        "id", "o.predicted_category", "o.confidence", "o.method"
    )


@query
@rounded("confidence", "ml_confidence")
def hybrid_predictions(spark, sf):
    second = fx.opinions(spark, sf).select("id", routing.read_answer(F.col("answer")).alias("opinion"))
    routed = routing.hybrid_route(_records(spark, sf), second, "id", THRESHOLD)
    return routed.select(
        "id", "predicted_category", "confidence", "needs_manual_review", "classification_method",
        F.col("ml_prediction.predicted_category").alias("ml_category"),
        F.col("ml_prediction.confidence").alias("ml_confidence"),
        F.col("gpt_prediction.predicted_category").alias("second_category"),
    )


@query
@rounded("average_confidence")
def scoring_counters(spark, sf):
    return profile.scoring_counters(_records(spark, sf))


@query
@rounded("confidence")
def prediction_json(spark, sf):
    """Compact JSON per prediction, read back field by field."""
    lines = json_output.prediction_json(_records(spark, sf), "id", compact=True)
    read = F.from_json("value", "predicted_category string, confidence double")
    return lines.select("id", read.alias("r"), F.size(F.json_object_keys("value")).alias("fields")).select(
        "id", "r.*", "fields"
    )


@query
def batch_envelopes(spark, sf):
    """Turns of a conversation as one batch of results, read back."""
    turns = fx.table(spark, sf, "conversations").select(
        "conv_id", F.col("turn").alias("pos"), F.col("role").alias("predicted_category"),
        F.col("turn").cast("double").alias("confidence"),
    )
    envelopes = json_output.batch_envelopes(turns, "conv_id", compact=True)
    read = F.from_json(
        "value", "count long, results array<struct<predicted_category:string,confidence:double>>"
    )
    return envelopes.select("conv_id", read.alias("r")).select(
        "conv_id", "r.count", F.posexplode("r.results").alias("place", "result")
    ).select("conv_id", "count", "place", "result.predicted_category", "result.confidence")


# --- features and models -------------------------------------------------


def _terms(spark, sf) -> DataFrame:
    return features.with_terms(fx.documents(spark, sf), "text", stop_words=STOP_WORDS).select("doc_id", "terms")


@query
def document_words(spark, sf):
    found = features.words(F.col("text"), STOP_WORDS)
    return fx.documents(spark, sf).select("doc_id", F.array_join(found, " ").alias("words"))


@query
def document_terms(spark, sf):
    return _terms(spark, sf).select("doc_id", F.array_join("terms", "|").alias("terms"))


@query
def term_counts(spark, sf):
    counted = features.with_term_counts(_terms(spark, sf))
    return (
        counted.select("doc_id", F.inline_outer("term_counts")).where(F.col("term").isNotNull())
    )


@query
@rounded("idf")
def vocabulary(spark, sf):
    return features.build_vocabulary(_terms(spark, sf))


@query
@rounded("weight")
def tfidf_weights(spark, sf):
    terms = materialize(_terms(spark, sf))
    known = features.build_vocabulary(terms)
    return features.tfidf_long(terms, known, "doc_id")


# Folders of the model and the prepared data that each application made of a
# feed: trained once, then read by whatever scores.
_trained: dict[tuple[str, str], tuple[str, str]] = {}


def trained_model(spark, sf) -> tuple[TicketClassifier, DataFrame]:
    made = (spark.sparkContext.applicationId, sf)
    if made not in _trained:
        data = prep.preprocess(standardize_tickets(fx.feed(spark, sf)))
        train_rows = data.splits.where(F.col("split") == "train")
        folders = scratch_path(spark, "model"), scratch_path(spark, "splits")
        TicketClassifier.fit(train_rows, data.label_map).save(folders[0])
        data.splits.write.parquet(folders[1])
        _trained[made] = folders
    model, splits = _trained[made]
    return TicketClassifier.load(spark, model), spark.read.parquet(splits)


def model_table(spark, sf) -> DataFrame:
    """The coefficients that were saved with the trained model."""
    trained_model(spark, sf)
    return spark.read.parquet(f"{_trained[spark.sparkContext.applicationId, sf][0]}/coefficients")


@query
def model_coefficients(spark, sf):
    """Class by term, and whether the loss is flat there: the trained model's proof."""
    _, splits = trained_model(spark, sf)
    rows = splits.where(F.col("split") == "train")
    slopes = certificate.loss_gradient(rows, model_table(spark, sf), "ordinal")
    return certificate.at_optimum(slopes, rows.count()).select("label", "category", "term", "at_optimum")


@query
def model_info(spark, sf):
    trained_model(spark, sf)
    folder = _trained[spark.sparkContext.applicationId, sf][0]
    return spark.read.parquet(f"{folder}/info").select(
        "model_type", "confidence_threshold", "num_classes", F.posexplode("categories").alias("label", "category")
    )


def _expected(spark, sf, texts: DataFrame, key: str, **options) -> DataFrame:
    return certificate.independent_records(texts, model_table(spark, sf), key, **options)


@query
def classifier_predictions(spark, sf):
    """Held-out predictions, each beside scores made of the coefficients alone."""
    model, splits = trained_model(spark, sf)
    held = splits.where(F.col("split") != "train")
    said = model.predict(held)
    consistent = (
        (F.element_at(scores.category_array(model.categories), F.col("pred") + 1) == F.col("predicted_category"))
        & (F.col("needs_manual_review") == (F.col("thresholded_category") == taxonomy.UNCATEGORIZED))
    )
    proved = certificate.certified(said, _expected(spark, sf, held, "ordinal"), "ordinal")
    return proved.select("ordinal", "label", (F.col("certified") & consistent).alias("certified"))


@query
def trained_and_validated(spark, sf):
    """The record that training leaves, beside one from the saved coefficients alone."""
    folder, output = scratch_path(spark, "prepared"), scratch_path(spark, "model")
    prep.preprocess(standardize_tickets(fx.feed(spark, sf)), fx.synthetic(spark, sf)).write(folder)
    model, record = train.train_job(spark, folder, output)
    held = feeds.read_split(spark, folder, "val")
    expected = certificate.independent_records(held, spark.read.parquet(f"{output}/coefficients"), "ordinal")
    names = feeds.read_label_map(spark, folder).select(
        F.col("label").alias("pred"), F.col("category").alias("predicted_category")
    )
    rows = (
        expected.join(F.broadcast(names), "predicted_category")
        .join(held.select("ordinal", "label"), "ordinal")
        .select(F.col("ordinal").alias("id"), "label", "pred", "confidence")
    )
    again = evaluation.split_evaluation(rows, "val", model.threshold)
    return certificate.certified(record, again, "split").select(
        "split", F.lit(held.count()).alias("tickets"), "certified"
    )


@query
def rejected_by_the_job(spark, sf):
    """Requests that the scoring job turns away, read back from its output."""
    model, _ = trained_model(spark, sf)
    folder = scratch_path(spark, "job")
    score.scoring_job(fx.requests(spark, sf), model, "id", folder)
    return spark.read.parquet(f"{folder}/rejected")


@query
def scored_tickets(spark, sf):
    model, _ = trained_model(spark, sf)
    feed = fx.feed(spark, sf)
    expected = _expected(spark, sf, cleaning.clean_joined(feed), "ordinal")
    proved = certificate.certified(score.score_tickets(feed, model, "ordinal"), expected, "ordinal")
    return proved.select("ordinal", "model_type", F.size("all_probabilities").alias("classes"), "certified")


def _requested(spark, sf) -> DataFrame:
    return cleaning.clean_joined(payloads.valid_tickets(payloads.parse_tickets(fx.requests(spark, sf))))


@query
def scored_requests(spark, sf):
    """Routed records, beside the coefficients' scores routed."""
    model, _ = trained_model(spark, sf)
    second = fx.opinions(spark, sf).select("id", routing.read_answer(F.col("answer")).alias("opinion"))
    routed = score.score_requests(
        fx.requests(spark, sf), model, "id", opinions=second, use_fallback=True
    )
    expected = routing.hybrid_route(_expected(spark, sf, _requested(spark, sf), "id"), second, "id")
    expected = expected.drop("ml_prediction", "gpt_prediction")
    return certificate.certified(routed, expected, "id").select("id", "certified")


@query
def scored_batches(spark, sf):
    """Envelopes read back, each result beside the coefficients' scores."""
    model, _ = trained_model(spark, sf)
    batches, folder = fx.request_batches(spark, sf), scratch_path(spark, "batches")
    score.batch_scoring_job(batches, model, "conv_id", folder, compact=True)
    read = F.from_json(
        "value", "count long, results array<struct<predicted_category:string,confidence:double>>"
    )
    place = F.concat_ws("/", "conv_id", "pos").alias("place")
    results = (
        spark.read.parquet(f"{folder}/envelopes").select("conv_id", read.alias("r"))
        .select("conv_id", "r.count", F.posexplode("r.results").alias("pos", "result"))
        .select("conv_id", "count", "pos", place, "result.*")
    )
    tickets_ = payloads.batch_tickets(payloads.parse_batches(batches), "conv_id").withColumn("place", place)
    expected = _expected(spark, sf, cleaning.clean_joined(tickets_), "place")
    return certificate.certified(results, expected, "place").select("conv_id", "pos", "count", "certified")


@query
def rejected_batches(spark, sf):
    """Batches that the job turns away, read back from its output."""
    model, _ = trained_model(spark, sf)
    folder = scratch_path(spark, "batches")
    score.batch_scoring_job(fx.request_batches(spark, sf), model, "conv_id", folder)
    return spark.read.parquet(f"{folder}/rejected")


def _by_length():
    """A stand-in model: the text's length picks the odds of four classes."""
    import numpy as np

    def predict(texts):
        sizes = np.array([len(t) % 8 for t in texts], dtype=np.float32)
        first = (sizes + 1) / 16
        return np.stack([first, 0.5 - first / 2, first / 4, 0.5 - 3 * first / 4], axis=1)

    return predict


@query
def batch_scorer_predictions(spark, sf):
    # Workers must be able to import the model's module.
    ship_package(spark, os.path.dirname(os.path.abspath(__file__)))
    scorer = BatchScorer(_by_length, ["a", "b", "c", "d"])
    return scorer.predict(fx.documents(spark, sf), "text").select(
        "doc_id", "pred", "confidence", "predicted_category", "thresholded_category"
    )


# --- streaming -----------------------------------------------------------


@query
def streamed_cleaning(spark, sf):
    source = spark.readStream.schema("doc_id long, text string").parquet(f"{sf}/documents.parquet*")
    # The table is one file with one row group: without this, one task.
    source = source.repartition(spark.sparkContext.defaultParallelism, "doc_id")
    out = scratch_path(spark, "cleaned")
    cleaned = streaming.clean_stream(source, ["text"]).select("doc_id", "text_clean")
    streaming.start_append(cleaned, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


@query
@rounded("average_confidence")
def streamed_counters(spark, sf):
    arrivals = scratch_path(spark, "arrivals")
    _records(spark, sf).repartition(4).write.parquet(arrivals)
    schema = spark.read.parquet(arrivals).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    out = scratch_path(spark, "counters")
    streaming.start_counters(
        streaming.running_counters(source), out, scratch_path(spark, "progress")
    ).awaitTermination()
    return streaming.latest_counters(spark, out)


_streamed: dict[tuple[str, str], str] = {}


def _scored_stream(spark, sf) -> str:
    """The folder of a stream that has scored all requests, once per application."""
    made = (spark.sparkContext.applicationId, sf)
    if made not in _streamed:
        model, _ = trained_model(spark, sf)
        arrivals, out = scratch_path(spark, "arrivals"), scratch_path(spark, "scores")
        fx.requests(spark, sf).repartition(4).write.json(arrivals)
        source = streaming.read_requests(spark, arrivals, files_per_batch=2)
        streaming.start_scoring(source, model, out, scratch_path(spark, "progress")).awaitTermination()
        _streamed[made] = out
    return _streamed[made]


@query
def streamed_scores(spark, sf):
    said = spark.read.parquet(f"{_scored_stream(spark, sf)}/predictions").drop("batch")
    expected = _expected(spark, sf, _requested(spark, sf), "id")
    return certificate.certified(said, expected, "id").select("id", "classification_method", "certified")


@query
def streamed_rejects(spark, sf):
    return spark.read.parquet(f"{_scored_stream(spark, sf)}/rejected").drop("batch")
