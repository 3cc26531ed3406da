"""The language model inside its classes."""

import zlib

import numpy as np
import pytest

from desksort.llm import language_model as lm

from .frames import frame


def vocabulary(words, monkeypatch):
    """All words but the two most frequent share classes."""
    monkeypatch.setattr(lm, "OWN", 2)
    counts = [700 - 5 * i for i in range(len(words))]
    shared = np.zeros((lm.SHARED, 2))
    for word, n in [*zip(words[3:], counts[3:]), (b"rare", 4), (b"pare", 1)]:
        shared[lm.shared_class(word)] += n, 1
    return lm.Vocabulary(words, counts, shared, int(shared[:, 0].sum()) + sum(counts[:3]), len(words) + 2)


def test_probabilities_of_all_words_add_up(monkeypatch):
    words = [b"the", b"of", lm.END, *[b"w%d" % i for i in range(130)]]
    v = vocabulary(words, monkeypatch)
    assert v.taught == sum(700 - 5 * i >= lm.LEAST for i in range(3, len(words)))
    model = lm.Model.start(v.share, node_bias=v.paths.bias)
    assert len(model.nodes) == v.taught and len(model.context) == v.classes + 1 + v.taught
    rng = np.random.default_rng(2)
    for part in (model.target, model.nodes):
        part[:] = rng.normal(size=part.shape)
    symbols = np.array([s for s in range(len(v.class_by_symbol)) if s != v.classes])
    context = np.tile(rng.integers(0, len(model.context), (1, lm.CONTEXT)), (len(symbols), 1))
    logs = model.log10(v.class_by_symbol[symbols], context, v.leaf_by_symbol[symbols], v.paths)
    assert (10**logs).sum() == pytest.approx(1, abs=1e-4)
    # A shared class's rarer words share its last leaf: their counts and one each, and one more.
    at = v.first_shared + lm.shared_class(b"rare")
    own = [n for w, n in zip(words[3:], v.counts[3:]) if n < lm.LEAST and lm.shared_class(w) == lm.shared_class(b"rare")]
    both = lm.shared_class(b"pare") == lm.shared_class(b"rare")
    assert both and 10 ** v.divisor[at] == pytest.approx(sum(own) + len(own) + 4 + 1 + 2 + 1)


def test_without_vectors_counts_alone_speak(monkeypatch):
    words = [b"the", b"of", lm.END, *[b"x%dne" % i for i in range(40)]]  # one class
    v = vocabulary(words, monkeypatch)
    model = lm.Model.start(v.share, node_bias=v.paths.bias)
    leaves = v.leaf_by_symbol[v.symbol[3:43]]
    logs = model._inside(np.zeros((40, lm.SIZE), dtype=np.float32), leaves, v.paths)
    assert np.exp(logs) == pytest.approx((v.counts[3:43] + 1) / (v.counts[3:43] + 1).sum(), rel=0.01)


def test_steps_climb_the_likelihood(monkeypatch):
    """Moves of nodes and contexts go the way the likelihood inside the classes rises."""
    words = [b"the", b"of", lm.END, *[b"x%dne" % i for i in range(40)]]
    v = vocabulary(words, monkeypatch)
    model = lm.Model.start(v.share, node_bias=v.paths.bias)
    trainer, rng = lm.Trainer(model, v.share, 1), np.random.default_rng(4)
    before = rng.integers(3, 43, 2000)
    numbers = np.stack([before, 3 + (before * 7) % 40], axis=1).ravel()  # each word says which comes next
    targets, context = lm.with_context([v.symbols(numbers)], v.classes)
    told = lambda: model.log10(v.class_by_symbol[targets], context, v.leaf_by_symbol[targets], v.paths)[1::2].mean()
    first = told()
    for _ in range(80):
        trainer.step(v.class_by_symbol[targets], context, v.leaf_by_symbol[targets], v.paths)
    assert told() > 0.5 * first


def test_words_of_a_class_are_told_apart_by_their_context(spark, monkeypatch):
    monkeypatch.setattr(lm, "OWN", 2)  # the words below share classes
    assert lm.shared_class(b"pine") == lm.shared_class(b"wine")
    trees, drinks = "fir ash pine", "ale rum wine"
    rows = [(i, " ".join([trees, drinks][i % 2] for _ in range(20))) for i in range(1500)]
    held = [i for i in range(2000, 2100) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    rows += [(held[0], trees), (held[1], drinks), (held[2], "fir ash wine"), (held[3], "ale rum pine")]
    df = frame(spark, rows, "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(df).where("held_out").collect()}
    assert min(got[held[0]], got[held[1]]) > max(got[held[2]], got[held[3]]) + 0.5
