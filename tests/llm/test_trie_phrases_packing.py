"""The prefix trie, collocations and packing beside brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from desksort.llm import collocations, packing, trie
from desksort.llm.queries import tokenizer_path

from .frames import awkward, awkward_rows, empty, frame, prose

TURNS = "conv_id long, turn long, role string, text string, depth int, n long"


# --- prefix trie ---------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        paths[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        weight = (len(who) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += weight
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), kids[node], leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found_trie(spark, rows, block=trie.BLOCK):
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], TURNS).repartition(3)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in trie.rebuilt_trie(df, block).select(*columns).collect()), key=str)


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_of_random_conversations(spark, block):
    rng = random.Random(block)
    rows = [
        (c, t, rng.choice("ua"), rng.choice(["x", "yy", "zzz"]) if t < 6 else "same")
        for c in [*range(0, 40), *range(100, 112), 205, 206, -3, -103]
        for t in range(rng.randint(1, 11))
    ]
    assert found_trie(spark, rows, block) == brute_trie(rows)


def test_trie_of_awkward_turns(spark):
    rows = [(0, None, None, None), (0, None, "a", "b"), (0, 1, "a", "b"), (0, 1, "a", "b"), (0, 1, "", None),
            (None, 1, "a", "lost"), (None, None, None, None), (301, 0, "user", "short"), (7, 5, "1:a", "b"),
            (7, 6, "1", ":ab"), (8, 5, "1", ":ab"), (8, 6, "1:a", "b"), (9, 0, "user", "é🙂" * 3000)]
    assert found_trie(spark, rows) == brute_trie(rows)
    assert found_trie(spark, []) == []


def test_trie_of_copies_and_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(9)]
    rows += [(1000, t, "user", f"turn {t % 7}") for t in range(600)]
    rows += [(2000, t, "user", f"turn {t % 7}") for t in range(600)]
    assert found_trie(spark, rows) == brute_trie(rows)


# --- collocations --------------------------------------------------------


def brute_phrases(rows, least=30, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            sizes[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        around = Counter()
        for p, n in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], n)
        ranked = []
        for p, a in often.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * around[p] < 80 * a:
                ranked.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        for i, (_, _, phrase, a, left, right, score) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, phrase.decode(), a, left, right, sizes[lang], score))
    return sorted(out)


def phrases(df, **settings_):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in collocations.collocations(df, **settings_).select(*names).collect())


def chatter(seed, n):
    rng = random.Random(seed)
    stock = ["good morning to you", "thank you very much", "of the", "in the house", "ÄRGER über Äpfel", "as soon as"]
    return " ".join(rng.choice(stock + ["red", "blue. green", "one,two", "the", "you"]) for _ in range(n))


def test_phrases_equal_brute_force(spark):
    rows = [(["en", "de", None, "und"][i % 4], chatter(i, 60)) for i in range(60)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n long, words int").repartition(3)
    want = brute_phrases(rows)
    assert {r[2].count(" ") for r in want} >= {1, 2, 3}
    assert phrases(df) == want
    # Words without an id are counted as text, to the same result.
    assert phrases(df, most_words=5) == want
    assert phrases(df, most_words=0) == want
    assert phrases(df, top=3) == brute_phrases(rows, top=3)


def test_phrases_of_awkward_rows(spark):
    rows = awkward_rows()
    assert phrases(awkward(spark), least=2) == brute_phrases([(r[2], r[1]) for r in rows], least=2)
    assert phrases(empty(spark)) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 4), st.integers(1, 2**20), st.integers(0, 2**31), st.integers(1, 10**12))
def test_layout_loses_nothing(size, n_ids, seed, tokens):
    layout = collocations.Layout(size, n_ids, tokens, 30)
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.integers(0, n_ids, 300), rng.integers(0, n_ids, 300)).astype("<i4")
    starts = np.arange(300 - size)
    high, low = layout.keys(ids, starts)
    for i, back in enumerate(layout.ids(high, low)):
        assert (back == ids[starts + i]).all()
    high, low, n = collocations.summed(high, low)
    assert n.sum() == len(starts)
    assert len(n) == len({tuple(ids[s : s + size]) for s in starts})
    for factor in (1, 200, 10**12):
        data = collocations.write_filter(high, low, n * factor, layout.half, layout.half)
        for got, want in zip(collocations.read_filter(data, layout.half, layout.half), (high, low, n * factor)):
            assert (got == want).all()


# --- packing -------------------------------------------------------------


def packed(df, **settings_):
    return packing.pack_documents(df, tokenizer_path("word_bpe_49k.json"), **settings_)


def brute_pieces(rows, length):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), length):
            part = ids[at : at + length]
            out.append((doc, at // length, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def assert_whole(rows, length):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("per_cell", [5, packing.PER_CELL])
def test_awkward_rows_are_packed(spark, per_cell):
    rows = packed(awkward(spark), per_cell=per_cell, length=512).collect()
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str)
    assert got == brute_pieces([(r[0], r[1]) for r in awkward_rows()], 512)
    assert_whole(rows, 512)
    assert packed(empty(spark)).count() == 0


def test_ids_are_those_of_whole_texts(spark):
    rng = random.Random(5)
    bits = ["a", "B", "I", "J", "̇", "̌", "é", " ", "\n", "\xa0", ".", ",", "'", "'s", "'S", "<|endoftext|>",
            "<|EndOfText|>", "<|", "23", "?!", "...", "İ", "ß", "Σ", "🙂", "\x1c", "\x0b", "_", "中", "x:y", "z;'re"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(3000)]
    got = packed(frame(spark, rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == brute_pieces(rows, 2048)


def brute_place(sizes, capacity):
    """Tries each open sequence, taking the whole sum of squares anew."""
    bins = []
    for size in sizes:
        def after(i):
            filled = Counter(b for b in bins if b < capacity)
            filled[bins[i]] -= 1
            if bins[i] + size < capacity:
                filled[bins[i] + size] += 1
            return sum(n * n for n in filled.values()), -bins[i]

        fits = [i for i, b in enumerate(bins) if b + size <= capacity and b < capacity]
        if fits:
            bins[min(fits, key=after)] += size
        else:
            bins.append(size)
    return sorted(bins)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_places_by_least_sum_of_squares(sizes):
    sequence, offset = packing.place(np.array(sizes, dtype=np.int64), 20)
    filled = Counter()
    for at, where, size in zip(sequence, offset, sizes):
        assert filled[at] == where
        filled[at] += size
    assert sorted(filled.values()) == brute_place(sizes, 20)


def test_few_sequences_and_their_ids(spark):
    rng = random.Random(2)
    rows = [(i % 3, prose(i, rng.choice([3, 20, 80, 200, 900]))) for i in range(400)]
    df = frame(spark, rows, "doc_id long, text string")
    out = packed(df, length=512, ids=True, per_cell=200).cache()
    total = sum(r["length"] for r in out.collect())
    assert assert_whole(out.collect(), 512) <= -(-total // 512) + 8
    whole = packing.sequences(out).collect()
    assert sum(len(r["ids"]) for r in whole) == total and max(len(r["ids"]) for r in whole) <= 512
    want = Counter(i for r in out.collect() for i in r["ids"])
    assert Counter(i for r in whole for i in r["ids"]) == want
    out.unpersist()
