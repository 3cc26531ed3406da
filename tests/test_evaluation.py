import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from desksort.operators import distributions, errors, tally
from desksort.plans import evaluate as ev
from tests.conftest import plan

CLASSES = [
    "Account Access / Login Issues", "Billing & Payments", "Bug / Defect Reports",
    "Feature Requests", "General Inquiries / Other", "How-To / Product Usage Questions",
    "Integration Issues", "Performance Problems", "Security & Compliance",
]
# Support, hits and predicted per class of two recorded
# evaluations, and the metrics recorded for them.
RECORDED = {
    "test": (
        [(2059, 1938, 2090), (447, 386, 446), (1171, 1086, 1174), (909, 817, 873),
         (1251, 1223, 1278), (697, 616, 704), (181, 144, 157), (274, 249, 268), (47, 41, 46)],
        {"accuracy": 0.923820352472996, "balanced_accuracy": 0.8965617620361408,
         "f1_weighted": 0.9235865940042277, "f1_macro": 0.9045599067088609,
         "f1_micro": 0.9238203524729961, "precision_weighted": 0.923756573633559,
         "precision_macro": 0.9136899813119932, "recall_macro": 0.8965617620361408,
         "cohen_kappa": 0.9072042710932423, "matthews_corrcoef": 0.9072463941197232},
        (6896, 6443, 140, 57, 0.9801023308698124, 0.9343097447795824, 0.40714285714285714),
    ),
    "val": (
        [(2059, 1939, 2063), (447, 382, 418), (1172, 1112, 1205), (910, 842, 903),
         (1251, 1227, 1283), (696, 605, 715), (181, 130, 147), (273, 240, 255), (47, 38, 47)],
        {"accuracy": 0.9259522455940875, "balanced_accuracy": 0.8807019310985166,
         "f1_weighted": 0.92549093199382, "f1_macro": 0.8916427185991286,
         "cohen_kappa": 0.9097896307229228, "matthews_corrcoef": 0.9098454753425216},
        (6881, 6450, 155, 65, None, None, None),
    ),
}


def rows_with_margins(classes, high_n, high_hits):
    """Predictions with the recorded margins; errors are paired off anyhow."""
    pairs = [(c, c) for c, (_, hits, _) in enumerate(classes) for _ in range(hits)]
    missed = [c for c, (support, hits, _) in enumerate(classes) for _ in range(support - hits)]
    given = [c for c, (_, hits, predicted) in enumerate(classes) for _ in range(predicted - hits)]
    for shift in range(len(given)):
        turned = given[shift:] + given[:shift]
        clash = [i for i, (a, b) in enumerate(zip(missed, turned)) if a == b]
        if not clash:
            break
        for i in clash:
            j = next(
                j for j in range(len(turned))
                if turned[j] != missed[i] and turned[i] != missed[j]
            )
            turned[i], turned[j] = turned[j], turned[i]
        if all(a != b for a, b in zip(missed, turned)):
            break
    wrong = list(zip(missed, turned))
    right_conf = [0.9] * high_hits + [0.5] * (len(pairs) - high_hits)
    wrong_conf = [0.8] * (high_n - high_hits) + [0.4] * (len(wrong) - high_n + high_hits)
    whole = [(*p, c) for p, c in zip(pairs + wrong, right_conf + wrong_conf)]
    return [(i, a, b, c) for i, (a, b, c) in enumerate(whole)]


@pytest.fixture(scope="module", params=sorted(RECORDED))
def recorded(request, spark):
    classes, metrics, confidence = RECORDED[request.param]
    rows = rows_with_margins(classes, confidence[0], confidence[1])
    df = spark.createDataFrame(rows, "id long, label int, pred int, confidence double")
    return df, metrics, confidence


def test_recorded_metrics(recorded):
    df, metrics, confidence = recorded
    assert df.count() == 7036
    counts = tally.tally(df)
    got = tally.agreement_metrics(tally.per_class(counts)).first().asDict()
    for name, value in metrics.items():
        assert got[name] == pytest.approx(value, abs=1e-12), name
    summary = tally.confidence_summary(counts).first()
    n_high, high_hits, n_low, low_hits, *_ = confidence
    assert (summary["n_high_confidence"], summary["n_low_confidence"]) == (n_high, n_low)
    assert summary["accuracy_high_confidence"] == pytest.approx(high_hits / n_high, abs=1e-15)
    assert summary["accuracy_low_confidence"] == pytest.approx(low_hits / n_low, abs=1e-15)


ODD = [
    # label, pred, confidence; class 3 is never true, class 2 never predicted
    (0, 0, 0.9), (0, 0, 0.7), (0, 1, 0.9), (1, 1, 0.5), (1, 3, 0.4), (2, 0, 0.8), (2, 1, 0.8),
    (2, 1, 0.3), (0, 3, 0.6),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, a, b, c, f"text {i}") for i, (a, b, c) in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "id long, label int, pred int, confidence double, text_clean string"
    )


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(i, f"class {i}") for i in range(4)], "label int, category string")


def test_confusion_matrix_fills_gaps(odd):
    cells = {(r["label"], r["pred"]): r for r in tally.confusion_matrix(tally.tally(odd)).collect()}
    assert len(cells) == 16
    assert cells[2, 1]["count"] == 2 and cells[2, 1]["share"] == pytest.approx(2 / 3)
    assert cells[2, 2]["count"] == 0 and cells[2, 2]["share"] == 0
    assert cells[3, 0]["count"] == 0 and cells[3, 0]["share"] is None


def test_classes_missing_on_one_side(odd):
    got = tally.agreement_metrics(tally.per_class(tally.tally(odd))).first()
    recalls = [2 / 4, 1 / 2, 0.0]
    assert got["balanced_accuracy"] == pytest.approx(np.mean(recalls))
    # Averages over classes take in the one that is only predicted.
    assert got["recall_macro"] == pytest.approx(np.mean([*recalls, 0]))
    assert got["precision_macro"] == pytest.approx(np.mean([2 / 3, 1 / 4, 0, 0]))


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 1, 1, 0.9), (1, 1, 1, 0.8)], "id long, label int, pred int, confidence double")
    counts = tally.tally(df)
    got = tally.agreement_metrics(tally.per_class(counts)).first()
    assert got["accuracy"] == 1.0 and got["cohen_kappa"] is None and got["matthews_corrcoef"] == 0.0
    summary = tally.confidence_summary(counts).first()
    assert summary["accuracy_low_confidence"] is None and summary["n_low_confidence"] == 0


def test_report_rows(odd, names):
    rows = tally.classification_report(tally.per_class(tally.tally(odd)), names).collect()
    assert [r["name"] for r in rows] == [
        "class 0", "class 1", "class 2", "class 3", "accuracy", "macro avg", "weighted avg"
    ]
    assert rows[4]["f1"] == pytest.approx(3 / 9) and rows[4]["precision"] is None
    assert {r["support"] for r in rows[4:]} == {9}


def test_confidence_against_numpy(odd):
    counts = tally.tally(odd)
    conf = np.array([c for _, _, c in ODD])
    wrong = np.array([a != b for a, b, _ in ODD])
    whole = tally.confidence_summary(counts).first()
    assert whole["mean_confidence"] == pytest.approx(conf.mean())
    assert whole["std_confidence"] == pytest.approx(conf.std())
    parts = {r["is_error"]: r for r in errors.error_confidence(counts).collect()}
    for flag in (True, False):
        assert parts[flag]["mean_confidence"] == pytest.approx(conf[wrong == flag].mean())
        assert parts[flag]["std_confidence"] == pytest.approx(conf[wrong == flag].std())


def test_error_patterns_and_ties(odd, names):
    top = errors.top_error_patterns(tally.tally(odd), names, 3).collect()
    assert [(r["rank"], r["true_category"], r["predicted_category"], r["count"]) for r in top] == [
        (1, "class 2", "class 1", 2), (2, "class 0", "class 1", 1), (3, "class 1", "class 3", 1)
    ]
    assert top[0]["percentage"] == pytest.approx(200 / 6)


def test_confident_errors_order(odd, names):
    top = errors.confident_errors(odd, names, 3).collect()
    assert [r["text_clean"] for r in top] == ["text 2", "text 5", "text 6"]
    assert top[0].asDict().keys() == {"text_clean", "true_category", "predicted_category", "confidence"}
    assert "TakeOrderedAndProject" in plan(errors.confident_errors(odd, names, 3))


def test_histogram_against_numpy(spark):
    rng = np.random.default_rng(11)
    series = {
        "a": np.round(rng.beta(9, 1, 4000), 2),  # many values right on edges
        "b": np.linspace(0.1, 0.9, 51),
        "c": np.array([0.5, 0.5]),
    }
    df = spark.createDataFrame([(k, float(v)) for k, vs in series.items() for v in vs], "s string, x double")
    rows = distributions.histogram(df, "s", "x").orderBy("series", "bin").collect()
    for name, values in series.items():
        mine = [r for r in rows if r["series"] == name]
        counts, edges = np.histogram(values, bins=50)
        density, _ = np.histogram(values, bins=50, density=True)
        assert [r["count"] for r in mine] == counts.tolist()
        assert [r["low"] for r in mine] == pytest.approx(edges[:-1].tolist())
        assert [r["density"] for r in mine] == pytest.approx(density.tolist())


def test_box_plot_whiskers(spark):
    values = [1.0, 2.0, 2.5, 3.0, 4.0, 5.0, 50.0, -40.0]
    df = spark.createDataFrame([("s", v) for v in values], "s string, x double")
    box = distributions.box_plot(df, "s", "x").first()
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (box["q1"], box["median"], box["q3"]) == pytest.approx((q1, median, q3))
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 5.0, 2)


def test_whole_evaluation(odd, names, tmp_path, spark):
    results = ev.evaluate(odd, names)
    lines = {(r["section"], r["line_no"]): r["text"] for r in results["summary"].collect()}
    assert lines["OVERALL METRICS", 1] == "Accuracy: 0.3333"
    assert lines["KEY INSIGHTS", 1] == "Model correctly classifies 33.33% of tickets"
    assert lines["KEY INSIGHTS", 3] == "Errors have 0.63 avg confidence (vs 0.70 for correct)"
    assert lines["TOP MISCLASSIFICATION PATTERNS", 1] == "class 2 → class 1: 2 (33.33%)"
    median = results["confidence"].first()["median_confidence"]
    assert median == pytest.approx(np.median([c for _, _, c in ODD]))
    ev.write_evaluation(results, str(tmp_path), "test")
    record = json.loads(spark.read.text(f"{tmp_path}/test/results").first()["value"])
    assert record["n_samples"] == 9 and record["split"] == "test"
    assert record["overall_metrics"]["agreement"]["accuracy"] == pytest.approx(1 / 3)
    assert len(record["error_analysis"]["top_misclassification_patterns"]) == 5
    assert spark.read.parquet(f"{tmp_path}/test/confusion_matrix").count() == 16


def test_no_errors_leaves_their_lines_out(spark, names):
    df = spark.createDataFrame(
        [(0, 0, 0, 0.9), (1, 1, 1, 0.8)], "id long, label int, pred int, confidence double"
    )
    results = ev.evaluate(df, names)
    sections = [r["section"] for r in results["summary"].collect()]
    assert "TOP MISCLASSIFICATION PATTERNS" not in sections and sections.count("KEY INSIGHTS") == 3
    assert results["error_examples"].count() == 0


def test_tally_combines_before_the_shuffle(spark):
    df = spark.range(10).select(
        "id", F.lit(0).alias("label"), F.lit(1).alias("pred"), F.lit(0.5).alias("confidence")
    )
    assert "partial_count" in plan(tally.tally(df))
