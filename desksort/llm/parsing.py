"""Document fingerprints by locally consistent parsing.

A text is a row of symbols: its words, named by 64-bit hashes. Each level cuts the row into phrases and names a phrase by its
symbols; the names are the next level's row, until one is left or the levels are
used up. Where a cut falls depends on a few neighbours only:

* a run of one repeated symbol is one phrase, named by symbol and length;
* elsewhere deterministic coin tossing reduces each symbol, beside its left
  neighbour, to a label of a few bits (the lowest differing bit's place and
  value), again and again until labels are below six; neighbours keep different
  labels, and local maxima of the labels begin phrases.

So equal substrings have equal phrase names but for a few at either end,
whatever stands before them. A fingerprint holds the ``size`` lowest names of
all levels and of the words, as hexadecimal text; the likeness of two is the share of names they
have in common among the lowest of both together, an estimate of the Jaccard
likeness of the names. Equal texts have equal fingerprints.

Defined cases: null texts are empty; a text without words has an empty
fingerprint, like another empty one (1) and unlike any other (0);
the document after is the next by id, then text, null ids first; the last one's
is the first, and a single row is its own; repeated rows are each other's
neighbours; no rows give no rows. Extra columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

LEVELS = 12
SIZE = 64
REMEMBERED = 300_000

_ODD = np.uint64(xxhash.xxh3_64_intdigest("phrase") | 1)
_RUN = np.uint64(xxhash.xxh3_64_intdigest("run") | 1)


class _Names(dict):
    def __missing__(self, symbol: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[symbol] = xxhash.xxh3_64_intdigest(symbol)
        return value


_name_of = _Names()


def _spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD
    return x ^ (x >> np.uint64(29))


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """The place of the lowest set bit; x is never 0."""
    low = x & (~x + np.uint64(1))
    return np.log2(low.astype(np.float64)).astype(np.uint64)


def _labels(row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing: labels below six, neighbours in a text different. first marks
    the symbols that begin a text; those toss against 0 and 1."""
    labels = row
    for _ in range(4):  # 64 bits: below 128, 14, 8, 6
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[first] = ~labels[first]  # differs in the lowest bit
        place = _lowest_bit(labels ^ left)
        labels = (place << np.uint64(1)) | ((labels >> place) & np.uint64(1))
    return labels


def _parse(row: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of a level: their names and documents."""
    n = len(row)
    first = np.ones(n, dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    # Runs of a repeated symbol become one symbol.
    begins = first.copy()
    begins[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, n)).astype(np.uint64)
    row = np.where(length > 1, _spread(row[at] ^ (length * _RUN)), row[at])
    doc, first = doc[at], first[at]
    n = len(row)
    # A run's name may by chance equal its neighbour: then they cannot differ.
    same = np.zeros(n, dtype=bool)
    same[1:] = (row[1:] == row[:-1]) & ~first[1:]
    row = row + same.astype(np.uint64)
    labels = _labels(row, first)
    last = np.ones(n, dtype=bool)
    last[:-1] = first[1:]
    before, after = np.empty(n), np.empty(n)
    own = labels.astype(np.float64)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = -1, -1
    # A phrase begins at a maximum, but not at a text's last symbol.
    cut = (own > before) & (own > after) & ~last
    # A phrase of one symbol next to another cut joins what follows.
    cut |= first
    at = np.flatnonzero(cut)
    phrase = np.cumsum(cut) - 1
    place = np.arange(n) - at[phrase]
    terms = _spread(row + (place.astype(np.uint64) + np.uint64(1)) * _RUN)
    names = _spread(np.add.reduceat(terms, at))
    return names, doc[at]


def fingerprints(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """The lowest distinct phrase names of each text, rising."""
    found = [t.split() for t in texts]  # at ASCII white space
    counts = np.array([len(f) for f in found])
    total = int(counts.sum())
    row = np.fromiter(map(_name_of.__getitem__, chain.from_iterable(found)), dtype=np.uint64, count=total)
    doc = np.repeat(np.arange(len(texts)), counts)
    names, docs = [row], [doc]
    for _ in range(LEVELS):
        if not len(row):
            break
        shorter, of = _parse(row, doc)
        names.append(shorter)
        docs.append(of)
        if len(shorter) == len(row):
            break
        # Texts that are one phrase are done.
        left = np.bincount(of, minlength=len(texts))[of] > 1
        row, doc = shorter[left], of[left]
    names, docs = np.concatenate(names), np.concatenate(docs)
    order = np.lexsort((names, docs))
    names, docs = names[order], docs[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]) | (docs[1:] != docs[:-1])
    names, docs = names[new], docs[new]
    edges = np.searchsorted(docs, np.arange(len(texts) + 1))
    return [names[a : min(b, a + size)] for a, b in zip(edges, edges[1:])]


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """The share of common names among the lowest of both together."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    lowest = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(common, lowest, assume_unique=True).sum() / len(lowest))


# --- neighbours ---------------------------------------------------------------


def _in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents in ranges of ids, each range with the document that follows it.

    Edges come from a sketch of the ids; one small pass finds the first id of
    each range. Those few documents are given to the range before as well
    (``guest``), the very first one to the last range.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    edges = [int(e) for e in edges]
    at = F.lit(0)
    if edges:
        after = F.transform(F.array(*[F.lit(e) for e in edges]), lambda e: (F.col("doc_id") >= e).cast("int"))
        at = F.coalesce(F.aggregate(after, F.lit(0), lambda a, x: a + x), F.lit(0))
    ranged = docs.withColumn("range", at)
    null_first = F.col("doc_id").isNotNull().cast("int")
    firsts = (
        ranged.groupBy("range")
        .agg(F.min(F.struct(null_first.alias("known"), "doc_id")).alias("first"))
        .orderBy("range").collect()
    )  # one row per range
    if not firsts:
        return ranged.withColumn("guest", F.lit(0)), n
    pairs = [(r["first"]["doc_id"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    guests = spark.createDataFrame(pairs, "first_id long, before int")
    sent = ranged.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first_id"))).select(
        "doc_id", "text", F.col("before").alias("range"), F.lit(1).alias("guest")
    )
    return ranged.withColumn("guest", F.lit(0)).union(sent), n


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
AT_ONCE = 500_000  # characters parsed together


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of range, guest, doc_id, text in order: each beside the next. Holds a
    stretch of rows and one more."""
    held: list[tuple] = []  # range, guest, doc_id, text
    size = 0

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, which is only a neighbour."""
        own = [i for i in range(len(rows) - 1) if not rows[i][1]]
        texts = [r[3] for r in rows]
        edited = []
        for i in own:
            k = len(texts[i]) // 4
            edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
        raw = [t.encode() for t in edited]
        prints = fingerprints([t.encode() for t in texts] + raw)
        mine, theirs = prints[: len(texts)], prints[len(texts) :]
        return pa.RecordBatch.from_pydict(
            {"doc_id": pa.array([rows[i][2] for i in own], pa.int64()),
             "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
             "edited_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
             "fingerprint": pa.array([written(mine[i]) for i in own], pa.string()),
             "edited_fingerprint": pa.array([written(t) for t in theirs], pa.string()),
             "near_edited": pa.array([likeness(mine[i], t) for i, t in zip(own, theirs)], pa.float64()),
             "near_next": pa.array([likeness(mine[i], mine[i + 1]) for i in own], pa.float64())}
        )

    for batch in batches:
        for r, g, d, t in zip(*(batch.column(i) for i in range(4))):
            row = (r.as_py(), g.as_py(), d.as_py(), t.as_py() or "")
            if row[1] and held and held[-1][1] and held[-1][0] == row[0]:
                continue  # rows that repeat the first id of the next range: one is enough
            held.append(row)
            size += len(row[3])
            if size > AT_ONCE and len(held) > 1:
                yield compared(held)
                held, size = held[-1:], len(row[3])
    if len(held) > 1:
        yield compared(held)


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, fingerprint, its edited text's digest
    and fingerprint, and the likeness to that and to the next document."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranged, n = _in_ranges(source)
    return (
        ranged.select("range", "guest", "doc_id", "text")
        .repartitionByRange(n, "range")
        .sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(_compare, SCHEMA)
    )
