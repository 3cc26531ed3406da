"""Quality rules and the quality classifier."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from desksort.llm import quality_classifier as qc
from desksort.llm import quality_rules as qr
from desksort.llm.textstats import with_statistics

from .frames import WORDS, awkward, awkward_rows, empty, frame, labels, prose


def brute_statistics(text):
    text = text or ""
    words = text.encode().split()
    words = [w.decode() for w in words]
    lines = [x for x in text.split("\n") if x.encode().split()]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)),
            len(covered), len(set(words)))


def statistics(df):
    s = [F.col(f"stats.{c}") for c in ("words", "word_chars", "symbols", "lines", "dup_lines", "repeat_words", "distinct_words")]
    return sorted(tuple(r) for r in with_statistics(df, "text").select(*s).collect())


def test_statistics_equal_brute_force(spark):
    assert statistics(awkward(spark)) == sorted(brute_statistics(r[1]) for r in awkward_rows())


def test_overlapping_repeats(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert statistics(df) == sorted(map(brute_statistics, texts))


def test_chi_square():
    assert qr.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert qr.chi_square_cdf(5.991, 2) == pytest.approx(0.95, abs=1e-4)


def good_rows(n):
    return [(i, prose(i, 40 + i % 50), "en", f"s{i % 2}") for i in range(n)]


def test_outliers_go_and_clean_stay(spark):
    odd = [(1000 + i, " ".join(w + "###$$" for w in prose(500 + i).split()), "en", "s1") for i in range(8)]
    df = frame(spark, good_rows(160) + odd, "doc_id long, text string, lang string, source string")
    rows = qr.apply_rules(df).collect()
    kept = {r["row"]["doc_id"]: r["kept"] for r in rows}
    assert all(kept[i] for i in range(160)) and not any(kept[1000 + i] for i in range(8))
    again = {r["row"]["doc_id"]: (r["kept"], r["distance"]) for r in qr.apply_rules(df).collect()}
    assert again == {r["row"]["doc_id"]: (r["kept"], r["distance"]) for r in rows}
    assert {r["doc_id"] for r in qr.keep_good(df).collect()} == {k for k, v in kept.items() if v}


@pytest.mark.parametrize("share", [0.3, 0.4, 0.45])
def test_copies_of_an_odd_text_go(spark, share):
    """However many they are, they count as one text; clean texts stay."""
    clean = [(i, prose(i, 40 + i % 50), "en", "s") for i in range(300)]
    odd = " ".join(w + "###$$" for w in prose(7, 60).split())
    copies = [(1000 + i, odd, "en", "s") for i in range(round(300 * share / (1 - share)))]
    df = frame(spark, clean + copies, "doc_id long, text string, lang string, source string")
    kept = {r["row"]["doc_id"]: r["kept"] for r in qr.apply_rules(df).collect()}
    assert not any(kept[i] for i, *_ in copies) and sum(kept[i] for i, *_ in clean) >= 297


def odd_share(share, width=0.25, n=400):
    """Normal vectors, and a share of others far away, so many times as wide."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 5)) * [0.2, 0.4, 0.1, 0.3, 0.2]
    x[: int(n * share)] = x[: int(n * share)] * width + [3, 4, 1, 3, 2]
    return np.round(x * qr.UNIT).astype(int)


@pytest.mark.parametrize("share, width", [(0.0, 1.0), (0.3, 0.25), (0.4, 1.0)])
def test_least_determinant_leaves_odd_vectors_out(spark, share, width):
    x = odd_share(share, width)
    df = frame(spark, [("en", "s", [int(v) for v in row]) for row in x], "lang string, source string, vector array<long>")
    p = qr.estimates(df).collect()[0]["p"]
    lower = np.zeros((5, 5))
    lower[np.tril_indices(5)] = p["triangle"]
    far = (((x - np.array(p["centre"])) @ lower.T) ** 2).sum(axis=1)
    odd = int(len(x) * share)
    assert (far[:odd] > 100).all() and (far[odd:] < qr.chi_square_quantile(0.9999, 5)).all()


def test_determinants_fall(spark):
    x = odd_share(0.35)
    vectors = frame(spark, [("g", [int(v) for v in row]) for row in x], "group string, vector array<long>")
    params, found = qr._start(vectors), []
    for _ in range(4):
        params = qr._concentrated(vectors, params, 0.5)
        found.append({r["start"]: r["det"] for r in params.collect()})
    assert all(b[s] <= a[s] + 0.02 for a, b in zip(found, found[1:]) for s in a)
    # The kept one is about the least met, and its half of the vectors is no odd one.
    best = qr._least(vectors, qr._start(vectors), 0.5, 50).collect()[0]["p"]
    lower = np.zeros((5, 5))
    lower[np.tril_indices(5)] = best["triangle"]
    assert -np.log(np.diag(lower)).sum() <= min(found[-1].values()) + 0.02
    assert np.abs(np.array(best["centre"]) / qr.UNIT).max() < 0.2


def test_duplicate_lines_and_repeats_reject(spark):
    """Either feature alone suffices in a group of clean texts."""
    once = "river stones"
    lines = [(1000 + i, "\n".join([once] * 6 + [prose(700 + i, 60), prose(750 + i, 9)]), "en", "s1") for i in range(3)]
    passage = [(2000 + i, " ".join([prose(800 + i, 50), prose(900, 12), prose(820 + i, 10), prose(900, 12)]), "en", "s1") for i in range(3)]
    df = frame(spark, good_rows(160) + lines + passage, "doc_id long, text string, lang string, source string")
    rows = {r["row"]["doc_id"]: r for r in qr.apply_rules(df).collect()}
    assert all(rows[i]["kept"] for i in range(160))
    assert not any(rows[i]["failed"] or rows[i]["kept"] for i in [1000, 1001, 1002, 2000, 2001, 2002])


def test_estimate_equals_numpy(spark):
    """Centre and distances of the last step, computed anew from its subset."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(400, 5)) * qr.UNIT).astype(int)
    df = frame(spark, [("en", "s", [int(v) for v in row]) for row in x], "lang string, source string, vector array<long>")
    p = qr.estimates(df, steps=0).collect()[0]["p"]
    start = np.array(p["centre"])
    assert np.abs(start - np.median(x, axis=0)).max() < qr.UNIT / 8
    moments = qr._moments(df.withColumn("group", F.lit("g")))
    est = qr._estimate(moments, 1.0).collect()[0]["p"]
    cov = np.cov(x.T, bias=True) + np.diag((np.array(qr.FLOORS) * qr.UNIT) ** 2)
    lower = np.zeros((5, 5))
    lower[np.tril_indices(5)] = est["triangle"]
    assert np.allclose(lower.T @ lower, np.linalg.inv(cov), rtol=1e-6)
    assert np.allclose(est["centre"], x.mean(axis=0))


def test_rules_take_awkward_and_empty(spark):
    rows = qr.apply_rules(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert all(not r["kept"] for r in rows if r["failed"])
    kept = qr.keep_good(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == sum(r["kept"] for r in rows)
    assert qr.apply_rules(empty(spark)).count() == 0 and qr.keep_good(empty(spark)).count() == 0


def test_salted_join_gives_the_same(spark):
    from desksort.session import joined

    rows = frame(spark, [("a" if i % 3 else None, i) for i in range(50)], "k string, v int")
    table = frame(spark, [("a", 1), (None, 2), ("b", 3)], "k string, w int")
    wanted = sorted(map(str, joined(rows, table, ["k"]).collect()))
    assert sorted(map(str, joined(rows, table, ["k"], few=0).collect())) == wanted


def test_classifier_learns(spark):
    junk = [(2000 + i, " ".join([WORDS[i % len(WORDS)]] * 60), "en", "s") for i in range(60)]
    df = frame(spark, good_rows(240) + junk, "doc_id long, text string, lang string, source string")
    known = labels(spark, "quality", [(r[0], int(r[0] < 2000)) for r in good_rows(240) + junk])
    scored = {r["doc_id"]: r for r in qc.score_documents(df, known).collect()}
    right = [r["predicted"] == int(i < 2000) for i, r in scored.items()]
    assert np.mean(right) > 0.97 and all(0 <= r["score"] <= 1 for r in scored.values())
    kept = {r["doc_id"] for r in qc.keep_good(df, known).collect()}
    assert kept == {i for i, r in scored.items() if r["predicted"]}


def test_classifier_takes_awkward_and_empty(spark):
    known = labels(spark, "quality", [(0, 1), (0, 0), (3, 1), (None, 1), (6, None), (99, 0), (12, 0)])
    scored = qc.score_documents(awkward(spark), known).collect()
    assert len(scored) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in scored)
    assert qc.keep_good(awkward(spark), known).columns == awkward(spark).columns
    none = qc.score_documents(awkward(spark), labels(spark, "quality")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    assert qc.score_documents(empty(spark), known).count() == 0


def test_normal_equations_are_sums(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(300, qc.N_FEATURES)), rng.integers(0, 2, 300).astype(float)
    df = frame(spark, [(r.tolist(), float(v)) for r, v in zip(x, y)], "features array<double>, y double").repartition(5)
    project = qc.Projection(np.zeros(qc.N_FEATURES), np.ones(qc.N_FEATURES), 16, 2.0, 1)
    z = project(x)
    assert np.allclose(qc._normal_equations(df, project, 16), z.T @ np.hstack([z, y[:, None]]))


def test_isotonic_rises():
    at, values = qc.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([10.0, 10, 10, 10]), np.array([1.0, 5, 3, 9]))
    assert list(at) == pytest.approx([0.1, 0.25, 0.4]) and (np.diff(values) > 0).all()
