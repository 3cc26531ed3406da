import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from desksort.functions import scores
from desksort.operators.routing import hybrid_route, read_answer
from desksort.sinks.json_output import batch_envelopes, prediction_json
from tests.conftest import plan

RECORD = (
    "ticket_id long, predicted_category string, confidence double, needs_manual_review boolean, "
    "model_type string, all_probabilities map<string,double>"
)


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [
        (i, "Bug / Defect Reports", c, c < 0.6, "baseline", {"Bug / Defect Reports": c})
        for i, c in enumerate([0.9, 0.6, 0.59, 0.5, 0.4, 0.3])
    ]
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def opinions(spark):
    rows = [(0, "Feature Requests"), (2, " Feature Requests\n"), (3, "uncertain"), (4, "Banana")]
    df = spark.createDataFrame(rows, "ticket_id long, answer string")
    return df.select("ticket_id", read_answer(F.col("answer")).alias("opinion"))


def test_answers(spark):
    cases = {
        "Billing & Payments": ("Billing & Payments", 0.7, "gpt"),
        "\tBilling & Payments ": ("Billing & Payments", 0.7, "gpt"),
        "billing & payments": None,
        "UNCERTAIN": ("Uncategorized", 0.0, "gpt_unknown"),
        " Uncertain\n": ("Uncategorized", 0.0, "gpt_unknown"),
        "uncertain.": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    got = df.select("a", read_answer(F.col("a")).alias("o")).collect()
    assert {r["a"]: r["o"] and tuple(r["o"]) for r in got} == cases


def test_every_branch(predictions, opinions):
    rows = {r["ticket_id"]: r for r in hybrid_route(predictions, opinions).collect()}
    assert len(rows) == 6
    short = {
        i: (r["classification_method"], r["predicted_category"], r["confidence"], r["needs_manual_review"])
        for i, r in rows.items()
    }
    bug = "Bug / Defect Reports"
    assert short == {
        0: ("ml", bug, 0.9, False),  # confident: its second opinion is not read
        1: ("ml", bug, 0.6, False),  # the threshold itself is confident
        2: ("gpt", "Feature Requests", 0.7, False),
        3: ("gpt_unknown", bug, 0.5, True),
        4: ("ml", bug, 0.4, True),
        5: ("ml", bug, 0.3, True),
    }
    assert rows[0]["ml_prediction"] is None and rows[0]["gpt_prediction"] is None
    assert rows[2]["ml_prediction"]["confidence"] == 0.59
    assert rows[3]["gpt_prediction"]["method"] == "gpt_unknown"
    assert rows[5]["gpt_prediction"] is None and rows[5]["ml_prediction"]["predicted_category"] == bug


def test_without_fallback(predictions, opinions):
    for routed in (
        hybrid_route(predictions, opinions, use_fallback=False), hybrid_route(predictions, None)
    ):
        rows = routed.collect()
        assert {r["classification_method"] for r in rows} == {"ml"}
        assert {r["ticket_id"] for r in rows if r["needs_manual_review"]} == {2, 3, 4, 5}
    assert hybrid_route(predictions, None).schema == hybrid_route(predictions, opinions, use_fallback=False).schema


def test_threshold_is_a_parameter(predictions, opinions):
    rows = hybrid_route(predictions, opinions, threshold=0.95).collect()
    assert {r["ticket_id"] for r in rows if r["classification_method"] == "gpt"} == {0, 2}


def test_routing_is_one_join_and_one_row_per_ticket(predictions, opinions):
    text = plan(hybrid_route(predictions, opinions))
    assert "Union" not in text and text.count("Join") == 1
    once = sorted(map(str, hybrid_route(predictions, opinions).collect()))
    assert sorted(map(str, hybrid_route(predictions, opinions.union(opinions)).collect())) == once


def test_softmax_and_order(spark):
    logits = [[1.0, 3.0, 3.0, -2.0], [1000.0, 999.0], [0.0]]
    df = spark.createDataFrame([(v,) for v in logits], "x array<double>")
    got = df.select(scores.softmax(F.col("x")).alias("p")).select(
        "p", scores.argmax(F.col("p")).alias("a"), scores.confidence(F.col("p")).alias("c")
    ).collect()
    for row, x in zip(got, logits):
        e = np.exp(np.array(x) - max(x))
        assert row["p"] == pytest.approx((e / e.sum()).tolist())
        assert row["a"] == int(np.argmax(e)) and row["c"] == pytest.approx(max(e / e.sum()))


def test_top_k_is_capped_and_keeps_label_order(spark):
    names = scores.category_array(["a", "b", "c"])
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    best = df.select(
        scores.top_k(F.col("p"), names, 2).alias("two"), scores.top_k(F.col("p"), names, 9).alias("all")
    ).first()
    assert [(r["category"], r["probability"]) for r in best["two"]] == [("b", 0.4), ("c", 0.4)]
    assert [r["category"] for r in best["all"]] == ["b", "c", "a"]


def test_json_full_and_compact(predictions):
    full = json.loads(prediction_json(hybrid_route(predictions, None), "ticket_id").first()["value"])
    assert list(full)[:4] == ["predicted_category", "confidence", "needs_manual_review", "model_type"]
    assert full["classification_method"] == "ml" and "ml_prediction" not in full
    compact = json.loads(prediction_json(predictions, "ticket_id", compact=True).first()["value"])
    assert compact == {"predicted_category": "Bug / Defect Reports", "confidence": 0.9}


def test_envelopes_keep_request_order(spark):
    rows = [(b, p, f"c{p}", p / 100) for b in (1, 2) for p in reversed(range(30))]
    df = spark.createDataFrame(rows, "b long, pos int, predicted_category string, confidence double")
    got = {r["b"]: json.loads(r["value"]) for r in batch_envelopes(df.repartition(4), "b").collect()}
    assert got[1] == got[2]
    assert got[1]["count"] == 30
    assert [r["predicted_category"] for r in got[1]["results"]] == [f"c{p}" for p in range(30)]
