"""Byte-level BPE encoding and decoding through a lexicon automaton.

The most frequent words of the whole corpus are merged once, on the driver, and
compiled with their ids into a minimal acyclic transducer (see ``lexicon``).
Workers map it into memory, look up the distinct pieces of many texts at a time,
and merge pieces that it lacks exactly. Ids never depend on the lexicon's words.

The tokenizer file is a parameter and is read on the driver only.

Defined cases: null texts are empty and have no ids; the text of an added token
is that token wherever it stands; pieces of any length are merged whole; rows
that repeat are encoded each; no rows give no rows. Extra columns may have any
names.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import lexicon
from .common import frequent, stored

# Fixed by the tokenizer: how text is cut before merging.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LEXICON_WORDS = 131_072
FLUSH = 300_000  # distinct words that a counting task holds
CACHE = 250_000  # pieces that a worker remembers
GROUP = 2_000_000  # characters that are looked up together


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones
    stand for themselves, the others follow from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


def read_model(path: str) -> dict[str, np.ndarray]:
    """Ids of bytes, merges by rank, bytes of each id, and added tokens."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    vocab, letters = data["model"]["vocab"], byte_letters()
    first = np.zeros(256, dtype=np.int32)
    for letter, byte in letters.items():
        first[byte] = vocab[letter]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
    added = {t["content"]: t["id"] for t in data["added_tokens"]}
    raw = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, at in vocab.items():
        raw[at] = bytes(letters[c] for c in token)
    for token, at in added.items():
        raw[at] = token.encode()
    return {
        "first": first,
        "left": np.array([vocab[a] for a, _ in pairs], dtype=np.int32),
        "right": np.array([vocab[b] for _, b in pairs], dtype=np.int32),
        "made": np.array([vocab[a + b] for a, b in pairs], dtype=np.int32),
        "raw": np.frombuffer(b"".join(raw), dtype=np.uint8),
        "raw_ends": np.cumsum([len(r) for r in raw]).astype(np.int64),
        "added": np.array(sorted(added.values()), dtype=np.int32),
    }


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of letters, roughly: runs between ASCII non-letters."""
    gaps = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
    found: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(
            {"run": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())}
        )
        found.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                found.update(text.as_py().encode().translate(gaps).split())
                if len(found) > FLUSH:
                    yield flush()
    yield flush()


def frequent_words(texts: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent runs of letters of all texts, at most ``words``."""
    counted = texts.mapInArrow(_count_runs, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(F.length("run") < lexicon.LONGEST), "bpe-counts")
    return [bytes(r["run"]) for r in counted.where(frequent(counted, "n", words)).collect()]


def build_lexicon(model: dict[str, np.ndarray], words: list[bytes]) -> bytes:
    """The packed model with the automaton of the words, alone and after a space."""
    merges = lexicon.Merges(model["first"], model["left"], model["right"], model["made"])
    forms = sorted({w for run in words for w in (run, b" " + run) if _is_one_piece(w)})
    ids = [merges.ids(w) for w in forms]
    return lexicon.pack(
        model
        | lexicon.compile_words(forms)
        | {
            "ids": np.array([i for one in ids for i in one], dtype=np.int32),
            "id_ends": np.cumsum([len(one) for one in ids]).astype(np.int64),
        }
    )


_pieces = regex.compile(PIECES)


def _is_one_piece(word: bytes) -> bool:
    return len(_pieces.findall(word.decode())) == 1


class Codec:
    """Encodes and decodes texts in a worker."""

    def __init__(self, blob: bytes):
        self.data = lexicon.mapped(blob)
        self.merges = lexicon.Merges(*(self.data[k] for k in ("first", "left", "right", "made")))
        ends = [0, *self.data["raw_ends"].tolist()]
        joined = self.data["raw"].tobytes()
        self.raw = [joined[a:b] for a, b in zip(ends, ends[1:])]
        added = {self.raw[i].decode(): i for i in self.data["added"].tolist()}
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) or r"(?!)")
        self.added_id = added
        self.written: dict[str, str] = {}  # a piece's ids, as decimals
        self.decoded: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; an added token is a piece between two cuts."""
        found, at = [], 0
        for token in self.added.finditer(text):
            found += _pieces.findall(text[at : token.start()])
            found.append(token.group())
            at = token.end()
        return found + _pieces.findall(text[at:] if at else text)

    def learn(self, pieces: set[str]) -> None:
        """Have the ids of all these pieces at hand."""
        missing = [p for p in pieces if p not in self.written]
        if len(self.written) + len(missing) > CACHE:
            self.written.clear()
            self.decoded.clear()
            missing = list(pieces)
        raw = [w.encode() for w in missing]
        numbers = lexicon.look_up(self.data, raw).tolist()
        ids, ends = self.data["ids"], self.data["id_ends"]
        for word, own, number in zip(missing, raw, numbers):
            if word in self.added_id:
                found = [self.added_id[word]]
            elif number >= 0:
                found = ids[ends[number - 1] if number else 0 : ends[number]].tolist()
            else:
                found = self.merges.ids(own)
            self.written[word] = ",".join(map(str, found))
            self.decoded[word] = b"".join([self.raw[i] for i in found])

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids as decimals joined by commas, and the text that they decode to."""
        cut = [self.pieces(t) for t in texts]
        self.learn({p for found in cut for p in found})
        for found in cut:
            yield (
                ",".join(map(self.written.__getitem__, found)),
                b"".join(map(self.decoded.__getitem__, found)).decode("utf-8", "replace"),
            )


_codecs: dict[str, Codec] = {}


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    lexicon_words: int = LEXICON_WORDS,
    digests: bool = False,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and ids (array) and decoded text, or
    with ``digests`` the SHA-256 of the ids joined by commas and of that text."""
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blob = build_lexicon(read_model(tokenizer_path), frequent_words(source.select("text"), lexicon_words))
    shared = spark.sparkContext.broadcast(blob)  # bounded by the lexicon's size

    key = hashlib.sha256(blob).hexdigest()

    def codec() -> Codec:
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = Codec(shared.value)
        return _codecs[key]

    def hexed(value: str) -> str:
        return hashlib.sha256(value.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            at = 0
            while at < batch.num_rows:
                texts, size, begin = [], 0, at
                while at < batch.num_rows and (size < GROUP or not texts):
                    texts.append(batch.column(1)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                rows = list(codec().encode_all(texts))
                counts = [ids.count(",") + 1 if ids else 0 for ids, _ in rows]
                out = {"doc_id": keys.slice(begin, at - begin), "n_tokens": pa.array(counts, pa.int64())}
                if digests:
                    out["ids_sha256"] = pa.array([hexed(ids) for ids, _ in rows], pa.string())
                    out["decoded_sha256"] = pa.array([hexed(back) for _, back in rows], pa.string())
                else:
                    lists = [[int(i) for i in ids.split(",")] if ids else [] for ids, _ in rows]
                    out["ids"] = pa.array(lists, pa.list_(pa.int32()))
                    out["decoded"] = pa.array([back for _, back in rows], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    last = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return source.mapInArrow(run, f"doc_id long, n_tokens long, {last}")
