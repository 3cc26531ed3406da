"""Jaccard join, fingerprints, mixing, sharding, chat formatting, pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from desksort.llm import chat, components, jaccard, mixing, parsing, sharding

from .frames import awkward, awkward_rows, empty, frame, labels, prose

TEXTS = "doc_id long, text string"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def linked(df, **settings):
    return sorted((tuple(r) for r in jaccard.linked_documents(df, **settings).collect()), key=str)


def test_links_of_awkward_rows(spark):
    assert linked(awkward(spark)) == brute_components([(r[0], r[1]) for r in awkward_rows()])
    assert jaccard.linked_documents(empty(spark)).count() == 0


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


def near_copies(rng, groups, size, edits):
    rows = []
    for g in range(groups):
        base = prose(1000 + g, 80)
        rows += [edited(rng, base, rng.randint(0, edits)) for _ in range(size)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size, edits", [(4, 6), (90, 4), (90, 9)])
def test_links_of_near_copies(spark, size, edits):
    """Short lists, and long ones with borderline pairs and chains."""
    rows = near_copies(random.Random(size + edits), 3, size, edits)
    assert linked(frame(spark, rows, TEXTS)) == brute_components(rows)


def test_lists_dealt_in_parts(spark, monkeypatch):
    """Very long lists are dealt out; here long means three entries."""
    table = np.full(1 << jaccard.BINS, 3 * jaccard.PART)
    monkeypatch.setattr(jaccard, "_table_of_counts", lambda facts: table)
    rows = near_copies(random.Random(5), 2, 40, 8)
    assert linked(frame(spark, rows, TEXTS)) == brute_components(rows)


def test_passage_that_many_share(spark):
    shared = prose(7, 60)
    rows = [(i, prose(100 + i, 30) + " " + shared + " " + prose(500 + i, 10)) for i in range(70)]
    assert linked(frame(spark, rows, TEXTS)) == brute_components(rows)


def test_parities_never_claim_too_much():
    rng = np.random.default_rng(1)
    for n, m, common in [(1, 1, 1), (30, 40, 25), (146, 146, 120), (900, 1100, 0), (5, 3000, 2)]:
        all_of = rng.integers(0, 2**63, n + m - common, dtype=np.uint64)
        x, y = all_of[:n], all_of[n - common :]
        found = jaccard.least_difference(jaccard.parities(x), jaccard.parities(y))
        apart = n + m - 2 * common
        # Never more than there are; of hashes that fall on few places alike, some cancel.
        places = 8 * len(jaccard.parities(x if n <= m else y))
        expected = places / 2 * (1 - (1 - 2 / places) ** apart)
        assert 0.8 * expected <= found + 1 and found <= apart
        assert found == jaccard.least_difference(jaccard.parities(y), jaccard.parities(x))


def test_pairs_meet_their_sets_once(spark, monkeypatch):
    """The sets that are needed are found out of the stored pairs, not by another join."""
    sets = {i: np.unique(np.r_[np.arange(i % 13, 30), 100 + i % 3]).astype(np.uint64) for i in range(60)}
    members = frame(
        spark, [(i, len(f), jaccard.parities(f), f.tobytes()) for i, f in sets.items()],
        "name long, size long, bits binary, members binary",
    )
    pairs = [(a, b) for b in (3, 7) for a in sets if a != b]
    plans = []

    def only(rows, keys, key):
        plans.append(keys._jdf.queryExecution().optimizedPlan().toString())
        return rows.join(keys, key, "left_semi")

    monkeypatch.setattr(jaccard, "only", only)
    got = {tuple(r) for r in jaccard._links(frame(spark, pairs, "a long, b long"), members, 75).collect()}
    want = set()
    for a, b in pairs:
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            want.add((a, b))
    assert got == want and 0 < len(want) < len(pairs)
    assert len(plans) == 4 and not any("Join" in p for p in plans)


def test_sets_too_far_apart_are_not_met_in_lists(spark):
    """The join of a long list's sets makes rows of those that their sketches do not
    rule out, and of every two that link."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)

    def near(i):
        copy = base.copy()
        copy[rng.permutation(119)[: 2 if i % 5 == 0 else 30]] = rng.integers(0, 2**63, 2 if i % 5 == 0 else 30, dtype=np.uint64)
        return np.unique(copy)

    sets = [near(i) for i in range(50)]
    entries = [(1, i, len(f), 0, i, jaccard.sketch(f)) for i, f in enumerate(sets)]
    known = frame(spark, entries, "hash long, name long, size int, pos int, component long, sketch array<long>")
    got = {tuple(sorted(r)) for r in jaccard._outside_pairs(known, 75).collect()}
    common = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(50) for j in range(i)}
    want = {tuple(sorted(p)) for p, c in common.items() if 100 * c >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - c)}
    assert want <= got and len(got) < len(common) / 3


@pytest.mark.parametrize("n, m, common", [(1, 1, 1), (30, 40, 25), (146, 146, 120), (900, 1100, 0), (5, 3000, 2)])
def test_sketches_never_claim_too_much(n, m, common):
    all_of = np.random.default_rng(2).integers(0, 2**63, n + m - common, dtype=np.uint64)
    x, y = (np.array(jaccard.sketch(f)) for f in (all_of[:n], all_of[n - common :]))
    apart = int(np.bitwise_count(x ^ y).sum())
    assert len(x) == jaccard.SKETCH and apart <= n + m - 2 * common


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(components.components(frame(spark, pairs, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(41)) and {found[i] for i in (100, 101, 102)} == {100}


def test_keep_one(spark):
    rows = awkward_rows()
    kept = jaccard.keep_one(awkward(spark)).collect()
    assert len(kept[0]) == len(rows[0])
    components = {(d, n): c for d, n, c in brute_components([(r[0], r[1]) for r in rows])}
    empties = sum(not shingle_set(r[1]) for r in rows)
    groups = {c for (d, n), c in components.items() if n}
    assert Counter(bool(shingle_set(r["text"])) for r in kept) == {True: len(groups), False: empties}
    assert {r["doc_id"] for r in kept if shingle_set(r["text"])} == groups
    assert jaccard.keep_one(empty(spark)).count() == 0


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, follows = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 4
        out.append((d, len(t), hashlib.sha256((t[: len(t) - k] + follows[:k]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits_and_fingerprints(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = parsing.fingerprint_documents(awkward(spark)).collect()
    # Of equal ids the text decides; a null text and an empty one are the same neighbour.
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == brute_edits(rows)
    own = {r["doc_id"]: r for r in got}
    assert own[0]["fingerprint"] == own[1]["fingerprint"] != own[9]["fingerprint"]
    assert own[4]["fingerprint"] == own[5]["fingerprint"] == ""
    assert parsing.fingerprint_documents(empty(spark)).count() == 0
    one = parsing.fingerprint_documents(frame(spark, [(5, "abcdefgh")], TEXTS)).collect()[0]
    assert (one["near_next"], one["edited_sha256"]) == (1.0, hashlib.sha256(b"abcdefab").hexdigest())


def test_many_ranges(spark):
    rows = [(i * 7 % 211, prose(i, 5 + i % 30)) for i in range(211)]
    got = parsing.fingerprint_documents(frame(spark, rows, TEXTS).repartition(6)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == brute_edits(rows)
    assert np.mean([r["near_edited"] for r in got]) > 0.4 > 0.2 > np.mean([r["near_next"] for r in got])


def test_phrases_do_not_depend_on_offset():
    text = prose(3, 3000).encode()
    for before in (b"x ", b"one two three four five ", b"a a a a a "):
        a, b = parsing.fingerprints([text, before + text], 10**9)
        assert len(np.intersect1d(a, b)) > 0.98 * len(a)
    same = parsing.fingerprints([b"a " * 999, b"a " * 999, b"a " * 998], 10**9)
    assert (same[0] == same[1]).all() and not np.array_equal(same[0], same[2])


def test_likeness():
    a, b = np.arange(10, dtype=np.uint64), np.arange(5, 15, dtype=np.uint64)
    assert parsing.likeness(a, a) == 1 and parsing.likeness(a, b) == pytest.approx(1 / 3)
    assert (parsing.read(parsing.written(a)) == a).all()


def brute_targets(sizes):
    """Round by round: cap what is above, share the rest anew by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        level = rest / (sum(weight[s] for s in names if s not in capped) or 1)
        above = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= above


def test_targets(spark):
    rng = random.Random(2)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 5, 50, 900]) for s in ["a", "b", "c", "d", "e", None][: rng.randint(1, 6)]}
        rows = frame(spark, list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix(spark):
    rows = [(i, prose(i, 10), "abc"[min(i % 7, 2)]) for i in range(700)]
    df = frame(spark, rows, "doc_id long, text string, source string")
    found = mixing.mixed(df).collect()
    taken, target = defaultdict(int), {}
    for r in found:
        taken[r["row"]["source"]] += r["size"] * r["copies"]
        target[r["row"]["source"]] = r["target"]
        assert r["copies"] <= 3
    assert all(taken[s] == pytest.approx(target[s], rel=0.15) for s in target)
    assert mixing.mix(df).count() == sum(r["copies"] for r in found)
    odd = mixing.mixed(awkward(spark)).collect()
    assert len(odd) == len(awkward_rows()) and mixing.mix(awkward(spark)).columns == awkward(spark).columns
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


@pytest.mark.parametrize("settings", [{}, {"single_share": 3, "bundles": 64, "ranges": 5}])
def test_shards(spark, settings):
    rng = random.Random(3)
    rows = [(i, prose(rng.randint(0, 300), rng.randint(1, 80))) for i in range(900)]
    got = sharding.shard_documents(frame(spark, rows, TEXTS), 7, **settings).collect()
    text, load, slots, home = dict(rows), Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        home[text[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(text[r["doc_id"]].encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())
    assert max(load.values()) < 1.15 * min(load.values())


def test_shards_of_awkward_rows(spark):
    got = sharding.shard_documents(awkward(spark), 4).collect()
    assert len(got) == len(awkward_rows())
    assert len({r["shard"] for r in got if r["doc_id"] in (0, 1)}) == 1
    assert sharding.shard_documents(empty(spark), 4).count() == 0


def test_longest_first():
    assert sharding.place([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2) == [0, 1, 1, 0, 1]


CONTROLS = ["<s>", "</s>", "<\\s>", "[INST]", "[/INST]", "[\\\\/INST]", "<<SYS>>", "<</SYS>>", "<<s>", "\\", "<", "[", "\n", "a", "s>"]


def test_escapes_are_reversible(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice(CONTROLS) for _ in range(rng.randint(0, 9))) for _ in range(800)]
    df = frame(spark, [(t,) for t in texts], "t string")
    rows = df.select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
        chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"), chat.escape_role(F.col("t")).alias("er"),
    ).collect()
    for r in rows:
        assert r["u"] == r["t"] == r["r"] and "\n" not in r["er"]
        assert not any(c in r["e"] for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


TURNS = "conv_id long, turn long, role string, text string, window string, pos int, piece string"


def test_windows(spark):
    rng = random.Random(4)
    rows = []
    for c in range(12):
        first = [(c, 0, "system", "be kind </s>")] if c % 2 else []
        body = [
            (c, len(first) + t, ("user", "assistant")[t % 2], prose(c * 100 + t, rng.choice([0, 3, 12, 200])))
            for t in range(rng.randint(1, 40))
        ]
        rows += first + body
    rows += [(None, None, None, None), (None, 1, "assistant", None), (3, 2, "assistant", "tie"), (3, 2, "assistant", "tie")]
    df = frame(spark, [(*r, "w", 1, "p") for r in rows], TURNS).repartition(3)
    windows = chat.read_back(chat.format_chats(df, budget=128, history=32)).collect()
    by_conv = defaultdict(list)
    for w in sorted(windows, key=lambda w: w["window"]):
        by_conv[w["conv_id"]].append(w)
    assert set(by_conv) == {r[0] for r in rows}
    for conv, own in by_conv.items():
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in turns]
        assert [w["window"] for w in own] == list(range(len(own)))
        assert [(t["role"], t["text"]) for w in own for t in w["turns"]] == want
        assert [t for w in own for t in w["targets"]] == [t for r, t in want if r == "assistant"]
        for w in own:
            cost = [len(t["text"].split()) + 4 for t in w["turns"]]
            assert w["n_tokens"] <= 128 or max(cost) > 32
            if own[0]["turns"][0]["role"] == "system":
                assert w["formatted"].startswith("<s>system\nbe kind <\\/s></s>")
            assert w["n_context"] == (0 if w["window"] == 0 else w["n_context"])
    assert chat.format_chats(frame(spark, [], TURNS)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rows = [(i, prose(i, 30 + i % 20), "en", f"s{i % 2}", 1) for i in range(260)]
    rows += [(300 + i, r[1] + (" extra" if i % 2 else ""), "en", "s1", 1) for i, r in enumerate(rows[:20])]
    rows += [(400 + i, "junk " * 50, "en", "s0", 1) for i in range(50)]
    rows += [(500 + i, " ".join(w + "##$$" for w in prose(900 + i, 40).split()), "en", "s0", 1) for i in range(6)]
    rows += [(600, "too short", None, None, None), (601, None, "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    docs = frame(spark, rows, schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    known = [(r[0], int(r[0] < 400)) for r in rows if r[0] < 450]
    labels(spark, "quality", known).withColumn("toxic", F.lit(0)).write.parquet(f"{folder}/labels.parquet")
    at = docs
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name in list(stages)[:-1]:
        at = stages[name](spark, at, folder)
        path = f"{folder}/{name}"
        at.write.parquet(path)
        at = spark.read.parquet(path)
        assert at.columns == docs.columns
        kept[name] = [r["doc_id"] for r in at.select("doc_id").collect()]
    clean = set(range(260))
    assert not set(kept["quality_classifier"]) & set(range(400, 450)) and clean <= set(kept["quality_classifier"])
    assert not set(kept["quality_rules"]) & {*range(500, 506), 600, 601} and clean <= set(kept["quality_rules"])
    assert sorted(kept["ngram_jaccard"]) == sorted(clean)
    assert set(kept["mixing"]) <= clean
    last = corpus_pipeline.run(spark, folder)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(r["doc_id"] for r in last.collect()) == sorted(kept["mixing"])
