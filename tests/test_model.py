import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from desksort.operators import certificate, features
from desksort.operators.classifier import BatchScorer, TicketClassifier, load_scorer
from desksort.operators.profile import class_weights
from desksort.plans import preprocess as prep
from desksort.plans import reuse, score, train
from desksort.sources.feeds import read_label_map, read_split
from tests.conftest import plan

TEXTS = [
    "the cat sat on the mat mat", "a cat and a dog dog dog", "dog café naïve CAFÉ", "x y zz",
    "", "Œuvre ﬁne straße Ångström 中文字 ёлка не дом ²x cat", "mat cat dog", "not a b c",
]


def tokens(text, stop):
    text = unicodedata.normalize("NFKD", text.lower())
    text = "".join(c for c in text if not unicodedata.combining(c))
    return [w for w in re.findall(r"\b\w\w+\b", text) if w not in stop]


def grams(words):
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


@pytest.fixture(scope="module")
def terms(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text_clean string")
    return features.with_terms(df).cache()


@pytest.fixture(scope="module")
def stop(spark):
    return set(features.default_stop_words())


def test_terms(terms, stop):
    got = {r["id"]: r["terms"] for r in terms.collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == grams(tokens(text, stop)), text


FORMS = [
    "½ cup ㎏ weight … ﬁn ㌀", "한국어 글 각 가나다 뷁", "ǆ ĳ ŉ ﷺ ℻ ⅷ ⒀ 🆎x", "plain ascii ½", "ﬃ ﬄs ﬆ ㍿ Ⅻ", "한", "",
]


def test_forms_of_any_length(spark, stop):
    df = spark.createDataFrame(list(enumerate(FORMS)), "id long, t string")
    got = {r["id"]: r["w"] for r in df.select("id", features.words(F.col("t")).alias("w")).collect()}
    assert got == {i: tokens(t, stop) for i, t in enumerate(FORMS)}
    assert got[0] == ["cup", "kg", "weight", "fin", "アハート"]
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    rows = ["".join(every[i : i + 400]) for i in range(0, len(every), 400)]
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(4)
    for r in df.select("t", features.strip_accents(F.col("t")).alias("s")).collect():
        form = "".join(unicodedata.normalize("NFKD", c) for c in r["t"])
        assert r["s"] == "".join(c for c in form if not unicodedata.combining(c))


def test_accents(spark):
    words = ["Ångström", "naïve", "ﬁne", "Ǆ", "Άλφα", "ёлка", "ｆｕｌｌ", "été", "plain"]
    df = spark.createDataFrame(list(enumerate(words)), "i int, t string")
    got = df.orderBy("i").select(features.strip_accents(F.lower("t"))).collect()
    want = [
        "".join(c for c in unicodedata.normalize("NFKD", w.lower()) if not unicodedata.combining(c))
        for w in words
    ]
    assert [r[0] for r in got] == want


def test_term_counts(terms, stop):
    for r in features.with_term_counts(terms).collect():
        assert {c["term"]: c["tf"] for c in r["term_counts"]} == dict(Counter(r["terms"]))


def vocabulary_of(docs, max_features, min_df, max_df):
    tf, df = Counter(), Counter()
    for d in docs:
        tf.update(d)
        df.update(set(d))
    kept = [t for t in tf if min_df <= df[t] <= max_df * len(docs)]
    kept = sorted(sorted(kept, key=lambda t: (-tf[t], t))[:max_features])
    return {t: (i, tf[t], df[t], math.log((1 + len(docs)) / (1 + df[t])) + 1) for i, t in enumerate(kept)}


@pytest.mark.parametrize(("size", "low", "high"), [(100, 1, 1.0), (100, 2, 0.95), (3, 1, 0.4)])
def test_vocabulary_and_weights(terms, size, low, high):
    docs = [r["terms"] for r in terms.orderBy("id").collect()]
    want = vocabulary_of(docs, size, low, high)
    known = features.build_vocabulary(terms, "terms", size, low, high)
    got = {r["term"]: (r["index"], r["tf"], r["df"], r["idf"]) for r in known.collect()}
    assert got == {t: (*v[:3], pytest.approx(v[3])) for t, v in want.items()}

    vectors = PipelineModel(features.vectorizer_stages(known)).transform(terms)
    dense = {r["id"]: r["v"] for r in vectors.select("id", vector_to_array("features").alias("v")).collect()}
    long = {(r["id"], r["term"]): r["weight"] for r in features.tfidf_long(terms, known, "id").collect()}
    for i, doc in enumerate(docs):
        raw = np.zeros(len(want))
        for t, n in Counter(doc).items():
            if t in want:
                raw[want[t][0]] = n * want[t][3]
        unit = raw / np.linalg.norm(raw) if raw.any() else raw
        assert dense[i] == pytest.approx(unit.tolist())
        assert [long.get((i, t), 0.0) for t in want] == pytest.approx(unit.tolist())


def test_term_counting_is_not_done_twice(terms):
    text = plan(features.build_vocabulary(terms))
    assert text.count("sort_array") == 1


WORDS = {
    "Billing": ["invoice", "refund", "charge", "payment"],
    "Login": ["password", "login", "locked", "reset"],
    "Speed": ["slow", "timeout", "lag", "latency"],
}


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Tickets of three uneven classes, prepared and written."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(360):
        name = ["Billing", "Billing", "Billing", "Login", "Login", "Speed"][i % 6]
        body = " ".join([*rng.choice(WORDS[name], 5), *rng.choice(["server", "client", "thing"], 3)])
        rows.append((i, f"t{i}", f"about {i} {body}", f"{body} number {i}", name))
    df = spark.createDataFrame(
        rows, "ordinal long, ticket_id string, title string, description string, category string"
    )
    extra = spark.createDataFrame(
        [(i, f"made up {i}", f"slow lag timeout slow {i}", "Speed") for i in range(10)]
        + [(10, rows[0][2], rows[0][3], "Speed"), (11, "odd", "no such category here", "Other")],
        "ordinal long, title string, description string, category string",
    )
    folder = str(tmp_path_factory.mktemp("prepared"))
    data = prep.preprocess(df, extra)
    data.write(folder)
    return folder, data


def test_prepared_output(spark, prepared):
    folder, data = prepared
    counts = {r["split"]: r["count"] for r in reuse.prepared_counts(spark, folder).collect()}
    stats = {r["stat"]: r["n"] for r in data.stats.where("split IS NULL").collect()}
    kept = stats["original_tickets"]
    held = math.ceil(0.3 * kept)
    assert counts["test"] == math.ceil(held / 2) and counts["val"] == held // 2
    assert counts["train"] == kept - held + stats["train_augmented_tickets"]
    assert stats["input_tickets"] == 360 == kept + stats["duplicates_removed"] + stats[
        "short_texts_removed"] + stats["extreme_cases_removed"]
    assert stats["synthetic_tickets"] == 12
    splits = spark.read.parquet(f"{folder}/splits")
    assert splits.where("is_synthetic AND split <> 'train'").count() == 0
    assert splits.where("category = 'Other' AND label IS NULL").count() == 1
    assert [r["category"] for r in read_label_map(spark, folder).orderBy("label").collect()] == sorted(WORDS)
    # No original ticket is in two splits.
    assert splits.where("NOT is_synthetic").groupBy("ordinal").count().where("count > 1").count() == 0


def test_one_split_reads_one_partition(spark, prepared):
    text = plan(read_split(spark, prepared[0], "val").select("text_clean"))
    assert "PartitionFilters: [isnotnull(split" in text and "title" not in text.split("ReadSchema")[1]


def test_missing_outputs_are_named(spark, prepared, tmp_path):
    with pytest.raises(reuse.MissingOutputs) as caught:
        reuse.prepared_counts(spark, str(tmp_path))
    assert caught.value.missing == ["train", "val", "test", "label_map"]
    spark.read.parquet(f"{prepared[0]}/splits").where("split <> 'val'").write.partitionBy("split").parquet(
        f"{tmp_path}/splits"
    )
    with pytest.raises(reuse.MissingOutputs, match="val, label_map"):
        reuse.prepared_counts(spark, str(tmp_path))


@pytest.fixture(scope="module")
def trained(spark, prepared, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("model"))
    model, record = train.train_job(spark, prepared[0], folder)
    return model, record, folder


def test_training_learns(trained):
    model, record, _ = trained
    row = record.first()
    assert row["split"] == "val" and row["accuracy"] > 0.95 and row["f1_weighted"] > 0.95
    assert model.training_stats["train_accuracy"] > 0.95
    assert model.info()["num_classes"] == 3


def test_solution_is_the_penalised_optimum(spark, prepared, trained):
    """Gradient of sum(weight * loss) + |w|^2 / 2 at the fitted weights."""
    model = trained[0]
    rows = read_split(spark, prepared[0], "train").where("label IS NOT NULL")
    pipeline = model.model
    vectors = PipelineModel(pipeline.stages[:-1]).transform(features.with_terms(rows))
    data = vectors.select("label", vector_to_array("features").alias("v")).collect()
    x = np.array([r["v"] for r in data])
    y = np.array([r["label"] for r in data])
    lr = pipeline.stages[-1]
    w, b = lr.coefficientMatrix.toArray(), np.array(lr.interceptVector)
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    counts = np.bincount(y)
    weight = len(y) / (len(counts) * counts[y])
    off = (p - np.eye(len(counts))[y]) * weight[:, None]
    scale = np.abs(w).max()
    assert np.abs(off.T @ x + w).max() < 0.02 * scale
    assert np.abs(off.sum(axis=0)).max() < 0.05 * len(y)


def test_coefficient_table_scores_like_the_model(spark, prepared, trained):
    model, _, folder = trained
    table = spark.read.parquet(f"{folder}/coefficients")
    rows = read_split(spark, prepared[0], "test")
    extra = rows.limit(1).withColumns({"ordinal": F.lit(-1).cast("long"), "text_clean": F.lit("")})
    rows = rows.unionByName(extra)  # a text without terms has the intercepts alone
    expected = certificate.independent_records(rows, table, "ordinal")
    proved = certificate.certified(model.predict(rows), expected, "ordinal")
    assert proved.where("certified").count() == rows.count()
    # One coefficient off is noticed, and so is a missing record.
    bent = table.withColumn("coefficient", F.col("coefficient") + F.when(F.col("term") == "", 0.01 * F.col("label")).otherwise(0))
    wrong = certificate.certified(model.predict(rows), certificate.independent_records(rows, bent, "ordinal"), "ordinal")
    assert wrong.where("certified").count() == 0
    alone = certificate.certified(model.predict(rows), expected.where("ordinal < 0"), "ordinal")
    assert alone.where("certified").count() == 1


def test_gradient_shows_the_optimum(spark, prepared, trained):
    model, _, folder = trained
    table = spark.read.parquet(f"{folder}/coefficients")
    rows = read_split(spark, prepared[0], "train").where("label IS NOT NULL")
    # Synthetic rows have ordinals of their own.
    rows = rows.withColumn("ordinal", F.col("ordinal") * 2 + F.col("is_synthetic").cast("int"))
    n = rows.count()
    found = certificate.loss_gradient(rows, table, "ordinal")
    assert found.count() == table.count()
    assert certificate.at_optimum(found, n).where("NOT at_optimum").count() == 0
    # Against the difference of the loss itself, away from the optimum.
    bent = table.withColumn("coefficient", F.col("coefficient") * 0.5).cache()
    weights = class_weights(rows).select("label", "weight")

    def loss(t):
        scored = certificate.table_scores(rows, t, "ordinal").join(rows.select("ordinal", "label"), "ordinal").join(weights, "label")
        fit = scored.agg(F.sum(-F.col("weight") * F.ln(F.get("probabilities", F.col("label"))))).first()[0]
        return fit + t.where("term <> ''").agg(F.sum(F.col("coefficient") ** 2)).first()[0] / 2

    slopes = {(r["label"], r["term"]): r["gradient"] for r in certificate.loss_gradient(rows, bent, "ordinal").collect()}
    step = 1e-4
    for at in [max(slopes, key=lambda k: (k[1] != "", abs(slopes[k]))), (0, ""), (1, "")]:
        here = (F.col("label") == at[0]) & (F.col("term") == at[1])
        up, down = (
            loss(bent.withColumn("coefficient", F.col("coefficient") + F.when(here, d).otherwise(0.0))) for d in (step, -step)
        )
        assert (up - down) / (2 * step) == pytest.approx(slopes[at], rel=1e-4, abs=1e-4)
    assert certificate.at_optimum(certificate.loss_gradient(rows, bent, "ordinal"), n).where("NOT at_optimum").count() > 0


def test_table_scores_shuffle_one_row_per_text(spark, prepared, trained):
    _, _, folder = trained
    table = spark.read.parquet(f"{folder}/coefficients")
    rows = read_split(spark, prepared[0], "test")
    scored = certificate.table_scores(rows, table, "ordinal")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    # What the batches sum up is what the rows' own terms give, one by one.
    weights = {(r["label"], r["term"]): (r["idf"], r["coefficient"]) for r in table.collect()}
    found = {r["ordinal"]: r for r in scored.collect()}
    terms = features.with_terms(rows.select("ordinal", "text_clean"), "text_clean", "terms")
    for r in terms.limit(5).collect():
        tf = {t: n for t, n in Counter(r["terms"]).items() if (0, t) in weights}
        length = sum((n * weights[0, t][0]) ** 2 for t, n in tf.items()) ** 0.5
        margins = [
            weights[k, ""][1] + sum(n * weights[k, t][0] * weights[k, t][1] for t, n in tf.items()) / (length or 1.0)
            for k in range(3)
        ]
        shares = np.exp(np.array(margins) - max(margins))
        assert found[r["ordinal"]]["length"] == pytest.approx(length)
        assert found[r["ordinal"]]["probabilities"] == pytest.approx(list(shares / shares.sum()))
    # A null text has the intercepts alone; rows of one key add up.
    none = rows.limit(1).select("ordinal", F.lit(None).cast("string").alias("text_clean"))
    assert [r["length"] for r in certificate.table_scores(none, table, "ordinal").collect()] == [0.0]
    twice = certificate.table_scores(rows.union(rows), table, "ordinal").collect()
    assert {r["ordinal"] for r in twice} == set(found) and len(twice) == len(found)
    assert all(r["length"] == pytest.approx(found[r["ordinal"]]["length"] * 2**0.5) for r in twice)


def test_model_info_is_a_table(spark, trained):
    model, _, folder = trained
    row = spark.read.parquet(f"{folder}/info").first()
    assert (row["num_classes"], row["categories"]) == (3, model.categories)
    assert row["train_accuracy"] == model.training_stats["train_accuracy"]


def test_saved_model_predicts_the_same(spark, trained, prepared):
    model, _, folder = trained
    again = load_scorer(spark, "baseline", folder)
    assert (again.categories, again.threshold) == (model.categories, model.threshold)
    rows = read_split(spark, prepared[0], "test")
    columns = ["ordinal", "pred", "confidence", "thresholded_category"]
    one, two = (m.predict(rows).select(*columns).orderBy("ordinal").collect() for m in (model, again))
    assert one == two
    with pytest.raises(ValueError, match="unknown model type"):
        load_scorer(spark, "other", folder)


def test_score_records(spark, trained):
    df = spark.createDataFrame(
        [(1, "Refund my invoice", "a payment and a charge"), (2, "x", None)],
        "id long, title string, description string",
    )
    rows = {r["id"]: r for r in score.score_tickets(df, trained[0], "id").collect()}
    assert rows[1]["predicted_category"] == "Billing"
    assert rows[1]["confidence"] == max(rows[1]["all_probabilities"].values())
    assert sum(rows[1]["all_probabilities"].values()) == pytest.approx(1)
    # Too short to keep, scored as empty text all the same.
    assert rows[2]["needs_manual_review"] and len(rows[2]["all_probabilities"]) == 3


def test_scoring_does_not_shuffle(spark, trained, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "'a title' title", "'some text' description").write.parquet(path)
    assert "Exchange" not in plan(score.score_tickets(spark.read.parquet(path), trained[0], "id"))


def test_scoring_job(spark, trained, tmp_path):
    values = ['{"title": "Refund", "description": "invoice charge payment"}'] * 3 + ["broken", '{"title": "x"}']
    df = spark.createDataFrame(list(enumerate(values)), "id long, value string")
    counters = score.scoring_job(df, trained[0], "id", str(tmp_path)).collect()
    assert {(r["predicted_category"], r["predictions"]) for r in counters} == {("Billing", 3), (None, 3)}
    assert spark.read.json(f"{tmp_path}/json").count() == 3
    rejected = spark.read.parquet(f"{tmp_path}/rejected").orderBy("id").collect()
    assert [tuple(r) for r in rejected] == [(3, "invalid_json"), (4, "missing_field")]


def test_batch_job_names_what_it_rejects(spark, trained, tmp_path):
    good = '{"tickets": [{"title": "Refund", "description": "invoice charge payment"}]}'
    values = [good, good[:-1], '{"tickets": [{"title": "x"}]}', '{"tickets": []}', None]
    df = spark.createDataFrame(list(enumerate(values)), "id long, value string")
    score.batch_scoring_job(df, trained[0], "id", str(tmp_path), compact=True)
    rejected = spark.read.parquet(f"{tmp_path}/rejected").orderBy("id").collect()
    assert [tuple(r) for r in rejected] == [(1, "invalid_json"), (2, "missing_field"), (4, "invalid_json")]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/envelopes").collect()] == [0]
    assert score.rejected_batches(df, "id").count() == 3


def test_batch_scorer(spark):
    def make():
        def predict(texts):
            return np.stack([[0.75, 0.25] if "a" in t else [0.4, 0.6] for t in texts])

        return predict

    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(100)], "id long, text_clean string")
    rows = BatchScorer(make, ["x", "y"], threshold=0.7, batch_size=8).predict(df).collect()
    assert {(r["text_clean"], r["predicted_category"], r["thresholded_category"]) for r in rows} == {
        ("a", "x", "x"), ("b", "y", "Uncategorized")
    }
