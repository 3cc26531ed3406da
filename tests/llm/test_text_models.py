"""Language model, encoding and toxicity."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from desksort.llm import bpe, lexicon, toxicity
from desksort.llm import language_model as lm
from desksort.llm.queries import tokenizer_path

from .frames import awkward, awkward_rows, empty, frame, labels, prose


def brute_base(rows):
    held = lambda d: zlib.crc32((str(d) if d is not None else "").encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not held(d) for w in lm.tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [
        (d, held(d), len(lm.tokens(t)), sum(counts[w] > 0 for w in lm.tokens(t)), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in lm.tokens(t)))
        for d, t in rows
    ]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


@pytest.mark.parametrize("known", [5, 100_000])
def test_base_scores(spark, known):
    got = lm.score_documents(awkward(spark), known=known).drop("score").collect()
    want = brute_base([(r[0], r[1]) for r in awkward_rows()])
    for g, w in zip(order([tuple(r) for r in got]), order(want), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5])


def test_model_is_normalised():
    rng = np.random.default_rng(1)
    words = [b"the", b"of", lm.END, b"stone", b"river", b"maple"]
    shared = np.zeros((lm.SHARED, 2))
    vocabulary = lm.Vocabulary(words, [9, 8, 7, 3, 2, 1], shared, 30, 6)
    model = lm.Model.start(vocabulary.share)
    model.target[:] = rng.normal(size=model.target.shape)
    context = np.tile(rng.integers(0, vocabulary.classes, (1, lm.CONTEXT)).astype(np.int16), (vocabulary.classes, 1))
    log10 = model.log10(np.arange(vocabulary.classes, dtype=np.int16), context)
    assert (10**log10).sum() == pytest.approx(1, abs=1e-5)


def test_training_raises_likelihood():
    share = np.full(6, 1 / 6)
    model = lm.Model.start(share)
    classes = [np.array([0, 1, 2, 3, 4, 5] * 200, dtype=np.int16)]
    targets, context = lm.with_context(classes, 6)
    before = model.log10(targets, context).sum()
    trainer = lm.Trainer(model, share, 1)
    for _ in range(60):
        trainer.step(targets, context)
    assert model.log10(targets, context).sum() > 0.6 * before


def test_model_beats_frequencies_on_held_out(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1200):  # two languages: the words before tell which goes on
        words = [("la", "de", "un", "que"), ("the", "of", "and", "to")][i % 2]
        rows.append((i, " ".join(rng.choice(words) for _ in range(60))))
    df = frame(spark, rows, "doc_id long, text string").coalesce(2)
    got = lm.score_documents(df).where("held_out").collect()
    assert sum(r["score"] for r in got) > 0.9 * sum(r["base_score"] for r in got)
    assert lm.score_documents(empty(spark)).count() == 0
    # In many small pieces the model learns as much.
    parted = lm.score_documents(df.repartition(24)).where("held_out").collect()
    whole, pieces = sum(r["score"] for r in got), sum(r["score"] for r in parted)
    assert abs(pieces - whole) < 0.02 * abs(whole)
    assert pieces > 0.9 * sum(r["base_score"] for r in parted)


LIBRARY = tokenizers.Tokenizer.from_file(tokenizer_path())
MODEL = bpe.read_model(tokenizer_path())
CODEC = bpe.Codec(bpe.build_lexicon(MODEL, [b"the", b"river", b"stone", b"\xc3\xa9t\xc3\xa9", b"Cloud"]))


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ",".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)


ALPHABET = st.one_of(
    st.characters(exclude_categories=["Cs"]),
    st.sampled_from([" ", "  ", "\n", "\t", "\x1c", " ", "the", " river", "'s", "'ll", "<|endoftext|>", "12", "!!"]),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=20).map("".join))
def test_encoding_equals_the_library(text):
    assert list(CODEC.encode_all([text])) == [library(text)]


def test_long_pieces():
    rng = random.Random(0)
    for n in (60, 64, 65, 66, 3000):
        text = "".join(rng.choice("etaoin") for _ in range(n))
        assert list(CODEC.encode_all([text])) == [library(text)]


def test_automaton_numbers_words():
    rng = random.Random(5)
    words = sorted({bytes(rng.choice(b"abc\x00\xff") for _ in range(rng.randint(1, 9))) for _ in range(3000)})
    automaton = lexicon.compile_words(words)
    assert lexicon.look_up(automaton, words).tolist() == list(range(len(words)))
    others = [w + b"zz" for w in words[:50]] + [b"", b"q", b"a" * 99]
    assert set(lexicon.look_up(automaton, others).tolist()) == {-1}
    assert len(automaton["finals"]) < sum(map(len, words)) / 2  # suffixes are shared
    back = lexicon.mapped(lexicon.pack(automaton))
    assert all((back[k] == automaton[k]).all() for k in automaton)


def test_encoded_documents(spark):
    rows = awkward_rows()
    got = bpe.encode_documents(awkward(spark), tokenizer_path(), lexicon_words=50).collect()
    want = sorted((r[0] is not None, r[0] or 0, *library(r[1] or "")) for r in rows)
    have = sorted((r["doc_id"] is not None, r["doc_id"] or 0, ",".join(map(str, r["ids"])), r["decoded"]) for r in got)
    assert have == want
    digests = bpe.encode_documents(awkward(spark), tokenizer_path(), lexicon_words=50, digests=True).collect()
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(r["ids_sha256"] for r in digests) == sorted(hexed(w[2]) for w in want)
    assert bpe.encode_documents(empty(spark), tokenizer_path()).count() == 0


def test_nearest_equals_brute_force():
    rng = random.Random(7)
    idf = {f"t{i}": 1 + rng.random() for i in range(40)}
    rows = []
    for i in range(900):
        v = {t: idf[t] * rng.randint(1, 3) for t in rng.sample(sorted(idf), rng.randint(1, 6))}
        norm = math.sqrt(sum(w * w for w in v.values()))
        rows.append((i, i % 2, {t: w / norm for t, w in v.items()}))
    index = toxicity.Index(idf, rows)
    vectors = {i: v for i, _, v in rows}
    for _ in range(60):
        text = " ".join(rng.choice(sorted(idf)) for _ in range(rng.randint(1, 5)))
        at, w = index.vector(text)
        q = {sorted(idf)[i]: x for i, x in zip(at, w)}
        cosines = {i: sum(q[t] * v.get(t, 0) for t in q) for i, v in vectors.items()}
        want = sorted((-round(c, 9), i) for i, c in cosines.items() if c > 0)[: toxicity.NEAREST]
        places, found = index.nearest(at, w)
        assert [(-round(c, 9) + 0.0, int(index.ids[p])) for p, c in zip(places, found)] == want


def test_nearest_equals_brute_force_with_marking_terms(monkeypatch):
    """The search in use: marking terms, many blocks, rare and common terms, whole batches."""
    monkeypatch.setattr(toxicity, "COMMON", 20)
    rng = np.random.default_rng(3)
    names = [f"t{i:03}" for i in range(400)]
    idf = 1 + rng.random(len(names)) * 5
    space = toxicity.Space(names, idf, np.array([5, 60, 61, 200, 399]), 7.0)
    odds = 1 / np.arange(1, 401)

    def text(kind: int) -> str:
        n = int(rng.integers(1, 40))
        own = (rng.choice(400, n, p=odds / odds.sum()) + 100 * kind) % 400
        return " ".join(names[i] for i in own) + (" other" if rng.random() < 0.3 else "")

    texts = [text(i % 4) for i in range(1200)]
    texts[700:720] = texts[:20]  # equal vectors
    vectors = [space.vector(*space.counts(t)[:2]) for t in texts]
    index = toxicity.Index.of(space, [(10_000 - i, i % 2, *v) for i, v in enumerate(vectors)])
    table = np.zeros((len(texts), space.size))
    for row, (at, w) in zip(table, vectors):
        row[at] = w
    asked = [index.vector(t) for t in [*texts[:100], *(text(i % 5) for i in range(300)), "", "nothing known"]]
    for (at, w), (places, cosines) in zip(asked, index.nearest_of(asked)):
        whole = table[:, at] @ w
        want = sorted((-round(c, 9), 10_000 - i) for i, c in enumerate(whole) if c > 0)[: toxicity.NEAREST]
        assert [int(i) for i in index.ids[places]] == [i for _, i in want]
        assert np.allclose(cosines, [-c for c, _ in want], atol=1e-8)


@pytest.mark.parametrize("text", [None, "", "".join(map(chr, range(128))), "A_b c-9\x1fd\x0be", "\u212a x", "Caf\u00e9 na\u0130ve\u2003b_\u0663"])
def test_terms_are_split_as_the_pattern_finds_them(text):
    assert toxicity.terms(text) == toxicity.TERM.findall((text or "").lower())
    assert all((c == " ") != bool(toxicity.TERM.match(chr(i))) for i, c in enumerate(toxicity.SPACED))


def test_postings_of_rare_terms_are_added_whole(monkeypatch):
    """They are kept by example alone; the blocks' maxima are those of the common terms."""
    monkeypatch.setattr(toxicity, "COMMON", 4)
    rows = [(i, i % 2, {"the": 0.1, f"r{i // 16}": 0.9}) for i in range(3200)]
    index = toxicity.Index({t: 1.0 for _, _, v in rows for t in v}, rows)
    index.postings()
    column, table, tops, starts, examples, weights = index._postings
    assert table.shape[0] == toxicity.BLOCK * tops.shape[1] and starts[-1] == len(examples) == len(weights)
    at, w = index.vector("the r7")
    places, _ = index.nearest(at, w)
    assert sorted(int(i) for i in index.ids[places]) == list(range(7 * 16, 8 * 16))


def test_toxicity_learns_and_leaves_clean_alone(spark):
    rng = random.Random(1)
    rows, known = [], []
    for i in range(500):
        words = prose(i, 50).split()
        if i % 5 == 0:
            words[10:10] = rng.sample(["scoundrel", "nitwit", "blockhead", "rascal"], 2)
        rows.append((i, " ".join(words)))
        known.append((i, int(i % 5 == 0)))
    df = frame(spark, rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, labels(spark, "toxic", known)).collect()}
    assert np.mean([got[i]["predicted"] == y for i, y in known]) > 0.98
    assert all(e["label"] == 1 for e in got[0]["evidence"])


def test_toxicity_takes_awkward_and_empty(spark):
    known = labels(spark, "toxic", [(0, 1), (1, 0), (2, 1), (7, 0), (8, 0), (None, 1), (9, None), (13, 1)])
    got = toxicity.score_documents(awkward(spark), known).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.score_documents(awkward(spark), labels(spark, "toxic")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert toxicity.score_documents(empty(spark), known).count() == 0


def test_toxicity_finds_copies_and_rare_kinds(spark):
    """A copy of a toxic example in plain words, and a kind in 0.6 % of the toxic rows."""
    rng = random.Random(3)
    rows, known = [], []
    for i in range(6000):
        words = prose(i, 30).split()
        if i % 2 == 0:
            words[10:10] = rng.sample(["scoundrel", "nitwit", "blockhead", "rascal"], 2) if i % 320 else ["vermin", "begone"]
        rows.append((i, " ".join(words)))
        known.append((i, int(i % 2 == 0)))
    plain = {i: prose(20_000 + i, 30) for i in range(12)}
    rows += [(7000 + i, text) for i, text in plain.items()]
    known += [(7000 + i, 1) for i in plain]
    rows += [(8000 + i, text) for i, text in plain.items()]
    rows += [(9000 + i, prose(30_000 + i, 14) + " vermin begone " + prose(40_000 + i, 14)) for i in range(12)]
    df = frame(spark, rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, labels(spark, "toxic", known)).collect()}
    own = [(got[8000 + i]["evidence"] or [None])[0] for i in plain]
    copies = [i for i, e in zip(plain, own) if e and e["similarity"] == pytest.approx(1) and e["doc_id"] == 7000 + i]
    assert len(copies) > 4 and all(got[8000 + i]["predicted"] for i in copies)  # the others were no examples
    assert all(got[9000 + i]["predicted"] for i in range(12))
    assert all(r["evidence"] for r in got.values())


def test_scores_of_all_classes_stay_in_a_cache(monkeypatch):
    classes = lm.OWN + 1 + lm.SHARED
    assert lm.CHUNK * classes * 4 <= 1 << 20
    rng = np.random.default_rng(7)
    share = rng.random(classes)
    model = lm.Model.start(share / share.sum())
    targets = rng.integers(0, classes, 20_000).astype(np.int16)
    context = rng.integers(0, classes + 1, (20_000, lm.CONTEXT)).astype(np.int16)
    found = model.log10(targets, context)
    monkeypatch.setattr(lm, "CHUNK", 8192)
    assert found == pytest.approx(model.log10(targets, context), abs=1e-6)


def test_a_context_is_normalised_once(monkeypatch):
    rng = np.random.default_rng(11)
    share = np.full(40, 1 / 40)
    model = lm.Model.start(share)
    context = np.repeat(rng.integers(0, 41, (500, lm.CONTEXT)).astype(np.int16), 20, axis=0)
    targets = rng.integers(0, 40, len(context)).astype(np.int16)
    made = []
    predictions = lm.Model.predictions

    def counted(self, some):
        made.append(len(some))
        return predictions(self, some)

    monkeypatch.setattr(lm.Model, "predictions", counted)
    found = model.log10(targets, context)
    assert sum(made) <= 500
    assert model.log10(targets, context) == pytest.approx(found) and sum(made) <= 500
    scores = predictions(model, context).astype(np.float64) @ model.target.T + model.bias
    want = scores[np.arange(len(targets)), targets] - np.log(np.exp(scores).sum(axis=1))
    assert found == pytest.approx(want / np.log(10), abs=1e-5)
    # A step changes the model, and what was kept with it.
    lm.Trainer(model, share, 3).step(targets[:100], context[:100])
    scores = predictions(model, context).astype(np.float64) @ model.target.T + model.bias
    want = scores[np.arange(len(targets)), targets] - np.log(np.exp(scores).sum(axis=1))
    assert model.log10(targets, context) == pytest.approx(want / np.log(10), abs=1e-5)
