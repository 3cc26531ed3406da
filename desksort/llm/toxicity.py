"""Toxicity by the nearest labelled examples.

Vectors have (1 + ln tf) x idf of every term, unit length, and every example that
has a term is in the index. Terms that mark toxic documents (chi-square over
labelled documents, with the level divided by the number of terms) stand in a
second part of the vector, unit length as well; in a text that has such terms that
part makes up MARKED of the squared length, as among hundreds of words two or three
would not show. The cosine is that of the whole vectors, so a copy of an example has
cosine 1 whatever its words are. A document's nearest examples by exact cosine vote
with weights that fall with distance; isotonic regression on labelled documents that
are no examples turns votes into probabilities. The nearest examples are given as
evidence.

Search: examples that are alike stand side by side (same marking terms, then spherical
k-means over the most common terms) and are cut into blocks. The inverted index keeps,
for the most common terms, which stand in most blocks, the greatest weight per term and
block and all weights, as matrices; for the other terms the postings. Postings of the
other terms are few and are all added up; with the block maxima of the common terms
they bound the cosine with any example of a block. The blocks with the best bounds
give a k-th best cosine, and only in blocks whose bound reaches it are the common terms
added, in single precision with a margin.
Examples that come near the k-th best sum are computed again in double precision, so
no example that belongs to the answer is skipped. Equal cosines go to the smaller id.

The model comes from a bounded sample of labelled rows, a parameter: per class at
most ``examples`` rows, and at most ``calibration`` others, those whose ids hash
lowest. So the index fits into memory at any size, and is broadcast. Document counts
for idf are those of the examples. All documents are scored, whole. The calibration
keeps texts with no, one, two, and more marking terms apart: a single one may stand
there by chance.

Defined cases: null and empty texts, and texts that share no term with an example,
have no neighbour and the rate of such rows as score; null labels are no labels; a
label whose id repeats counts for each row; without labels every score is 0.5; no
rows give no rows. Extra columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice, repeat
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import crc_of_id, stored
from .quality_classifier import isotonic

TERM = re.compile(r"\w+")
SPACED = "".join(c if TERM.match(c) else " " for c in map(chr, range(128)))  # of ASCII, what stands in a term
NEAREST = 16
CELLS = 1000
RICH = 3  # marking terms in a text beyond which more are not told apart
MARKED = 0.9  # of a vector's squared length is of the marking terms, if it has any
BLOCK = 32  # examples
FIRST = 4  # blocks summed first, for a k-th best cosine
COMMON = 1024  # terms with most examples
TOGETHER = 256  # documents compared at once
CENTRES = 128
CLOSE = 0.01  # distance below which a neighbour weighs no more
MARGIN = 1e-4  # more than sums in single precision can be off


def terms(text: str | None) -> list[str]:
    """As ``TERM`` finds them in the lower-case text."""
    low = (text or "").lower()
    return low.translate(SPACED).split() if low.isascii() else TERM.findall(low)


class Space:
    """Terms, their idf, and which of them mark toxic documents."""

    def __init__(self, names: list[str], idf: np.ndarray, marking: np.ndarray, unseen: float):
        """names: in order; marking: numbers of terms; unseen: idf of any other term."""
        self.names, self.idf, self.unseen = names, idf, unseen
        self.size = len(names) + len(marking)
        # Place of a marking term in the second part, or -1.
        self.second = np.full(len(names), -1, dtype=np.int64)
        self.second[marking] = len(names) + np.arange(len(marking))
        self._term = None

    def __getstate__(self):
        return self.__dict__ | {"_term": None, "names": "\n".join(self.names)}

    def __setstate__(self, state):
        names = state["names"]
        self.__dict__.update(state, names=names.split("\n") if names else [])

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray, float]:
        """Numbers and frequencies of a text's terms, and the squared length of the
        terms that no example has."""
        if self._term is None:
            # Frequent terms lie side by side in memory, as most of a text is of them.
            order = np.argsort(self.idf, kind="stable").tolist()
            names = "\n".join(self.names[i] for i in order).split("\n") if order else []
            self._term = dict(zip(names, order))
        found = Counter(terms(text))
        at = np.fromiter(map(self._term.get, found, repeat(-1)), dtype=np.int32, count=len(found))
        tf = np.fromiter(found.values(), dtype=np.int32, count=len(found))
        known = at >= 0
        other = float(((1 + np.log(tf[~known])) ** 2).sum()) * self.unseen**2
        at, tf = at[known], tf[known]
        order = np.argsort(at)
        return at[order], tf[order], other

    def vector(self, at: np.ndarray, tf: np.ndarray, other: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of the unit vector."""
        if not len(at):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        w = (1 + np.log(tf)) * self.idf[at]
        second = self.second[at]
        marks = second >= 0
        unit = w / np.sqrt(w @ w + other)
        if not marks.any():
            return at.astype(np.int64), unit
        marked = w[marks] / np.sqrt(w[marks] @ w[marks])
        places = np.concatenate([at.astype(np.int64), second[marks]])
        return places, np.concatenate([unit * math.sqrt(1 - MARKED), marked * math.sqrt(MARKED)])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _common(at: np.ndarray, size: int) -> np.ndarray:
    """Per place its number among those that stand there most often, or -1."""
    often = np.bincount(at, minlength=size)
    column = np.full(size, -1, dtype=np.int32)
    column[np.argsort(-often, kind="stable")[:COMMON]] = np.arange(min(size, COMMON))
    return column


def _alike(starts: np.ndarray, at: np.ndarray, w: np.ndarray, size: int, names: int) -> np.ndarray:
    """An order in which vectors that are alike come together: by their last place
    beyond the names, by spherical k-means over common places, by number of places."""
    n = len(starts) - 1
    rows = np.repeat(np.arange(n), np.diff(starts))
    column = _common(at, size)
    own = column[at] >= 0
    vectors = np.zeros((n, column.max(initial=-1) + 1), dtype=np.float32)
    vectors[rows[own], column[at[own]]] = w[own]

    def unit(m: np.ndarray) -> np.ndarray:
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)

    vectors = unit(vectors)
    centres = vectors[np.linspace(0, n - 1, min(n, CENTRES)).astype(int)]
    for _ in range(5):
        group = (vectors @ centres.T).argmax(axis=1)
        member = np.zeros((len(centres), n), dtype=np.float32)
        member[group, np.arange(n)] = 1
        centres = unit(member @ vectors)
    last = np.zeros(n, dtype=np.int64)
    beyond = at >= names
    np.maximum.at(last, rows[beyond], at[beyond])
    return np.lexsort((np.diff(starts), group, last))


class Index:
    """Unit vectors of examples, and their postings by term and block. Examples with
    equal vectors are compared once."""

    def __init__(self, weight: dict[str, float], rows: list[tuple[int, int, dict[str, float]]]):
        """weight: idf of each term; rows: id, label and vector of each example."""
        names = sorted(weight)
        number = {t: i for i, t in enumerate(names)}
        idf = np.array([weight[t] for t in names])
        # No documents are counted here: an unseen term is as rare as the rarest.
        space = Space(names, idf, np.zeros(0, dtype=np.int64), float(idf.max()) if len(idf) else 1.0)
        vectors = []
        for i, y, v in rows:
            at = sorted((number[t], w) for t, w in v.items())
            vectors.append((i, y, np.array([a for a, _ in at], dtype=np.int64), np.array([w for _, w in at])))
        self._set(space, vectors)

    @classmethod
    def of(cls, space: Space, vectors: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Index:
        index = cls.__new__(cls)
        index._set(space, vectors)
        return index

    def _set(self, space: Space, vectors: list) -> None:
        self.space = space
        groups: dict[bytes, list] = {}
        for row in vectors:
            if len(row[2]):
                groups.setdefault(row[2].tobytes() + row[3].tobytes(), []).append(row)
        own = sorted((sorted(g, key=lambda r: r[:2]) for g in groups.values()), key=lambda g: g[0][:2])
        if own:
            ends = np.append(0, np.cumsum([len(g[0][2]) for g in own]))
            at, w = (np.concatenate([g[0][i] for g in own]) for i in (2, 3))
            own = [own[i] for i in _alike(ends, at, w, space.size, len(space.names))]
        members = [r for g in own for r in g]
        self.ids = np.array([r[0] for r in members], dtype=np.int64)
        self.labels = np.array([r[1] for r in members], dtype=np.float64)
        self.members = np.append(0, np.cumsum([len(g) for g in own])).astype(np.int64)
        self.starts = np.append(0, np.cumsum([len(g[0][2]) for g in own])).astype(np.int64)
        self.at = np.concatenate([np.zeros(0), *[g[0][2] for g in own]]).astype(np.int32)
        self.w = np.concatenate([np.zeros(0), *[g[0][3] for g in own]])
        self._postings = None

    def __getstate__(self):
        return self.__dict__ | {"_postings": None}

    def postings(self) -> tuple:
        """Columns of the common terms (-1: none), their weights by example and their
        greatest weights by block. Of the other terms: starts of their postings;
        examples and weights of the postings."""
        if self._postings is None:
            n, size = len(self.starts) - 1, self.space.size
            rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.starts))
            column = _common(self.at, size)
            dense = column[self.at] >= 0
            table = np.zeros((-(-n // BLOCK) * BLOCK, column.max(initial=-1) + 1), dtype=np.float32)
            table[rows[dense], column[self.at[dense]]] = self.w[dense]
            tops = table.reshape(-1, BLOCK, table.shape[1]).max(axis=1).T.copy()
            by_term = np.flatnonzero(~dense)
            by_term = by_term[np.argsort(self.at[by_term], kind="stable")]  # in a term, by example
            starts = np.append(0, np.cumsum(np.bincount(self.at[by_term], minlength=size)))
            self._postings = column, table, tops, starts, rows[by_term], self.w[by_term].astype(np.float32)
        return self._postings

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of a text's unit vector."""
        return self.space.vector(*self.space.counts(text))

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST) -> list:
        """Per vector, places and cosines of the k nearest examples, nearest first."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0)
        if len(self.starts) < 2:
            return [none for _ in vectors]
        column, table, tops, starts, examples, weights = self.postings()
        n_blocks = tops.shape[1]
        asked = np.zeros((len(vectors), len(tops)), dtype=np.float32)
        others = np.zeros((len(vectors), n_blocks * BLOCK), dtype=np.float32)
        for i, (at, w) in enumerate(vectors):
            dense = column[at] >= 0
            asked[i, column[at[dense]]] = w[dense]
            at, w = at[~dense], w[~dense]
            sizes = starts[at + 1] - starts[at]
            own = _ranges(starts[at], sizes)
            others[i] = np.bincount(examples[own], np.repeat(w, sizes) * weights[own], others.shape[1])
        others = others.reshape(len(vectors), n_blocks, BLOCK)
        bounds = others.max(axis=2) + asked @ tops
        sums = np.zeros_like(others)

        def add_up(some: np.ndarray) -> None:
            """The sums of all terms, for the blocks chosen for each vector."""
            for block in np.flatnonzero(some.any(axis=0)):
                here = np.flatnonzero(some[:, block])
                sums[here, block] = others[here, block] + asked[here] @ table[block * BLOCK : (block + 1) * BLOCK].T

        tried = np.zeros(bounds.shape, dtype=bool)
        needed = min(n_blocks, -(-k // BLOCK) + FIRST)
        best = np.argpartition(bounds, n_blocks - needed, axis=1)[:, n_blocks - needed :]
        np.put_along_axis(tried, best, True, axis=1)
        add_up(tried)
        seen = np.take_along_axis(sums, best[:, :, None], axis=1).reshape(len(vectors), -1)
        kth = max(0, seen.shape[1] - k)
        least = np.maximum(np.partition(seen, kth, axis=1)[:, kth] - MARGIN, 0) if seen.shape[1] > k else np.zeros(len(seen))
        add_up((bounds > least[:, None]) & ~tried)

        whole, out = np.zeros(self.space.size), []
        for total, low, (at, w) in zip(sums.reshape(len(vectors), -1), least, vectors):
            near = np.flatnonzero(total > low)
            if len(near) > k:
                near = near[total[near] >= np.partition(total[near], len(near) - k)[len(near) - k] - MARGIN]
            if not len(near):
                out.append(none)
                continue
            whole[at] = w
            first, last = self.starts[near], self.starts[near + 1]
            own = [slice(f, l) for f, l in zip(first.tolist(), last.tolist())]
            shares = whole[np.concatenate([self.at[s] for s in own])]
            shares *= np.concatenate([self.w[s] for s in own])
            exact = np.add.reduceat(shares, np.cumsum(last - first) - (last - first))
            whole[at] = 0
            sizes = np.minimum(self.members[near + 1] - self.members[near], k)
            places, cosines = _ranges(self.members[near], sizes), np.repeat(exact, sizes)
            best = np.lexsort((self.ids[places], -np.round(cosines, 9)))[:k]
            out.append((places[best], cosines[best]))
        return out

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, nearest first."""
        return self.nearest_of([(at, w)], k)[0]

    def votes(self, texts: Iterable[str | None]) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
        """Per text one more than its marking terms (0 if no example is near, RICH + 1
        for more), the weighted share of toxic neighbours, and the neighbours."""
        texts = iter(texts)
        while some := [self.vector(t) for t in islice(texts, TOGETHER)]:
            for (at, _), (places, cosines) in zip(some, self.nearest_of(some)):
                if not len(places):
                    yield 0, 0.0, places, cosines
                    continue
                near = 1 / (np.maximum(1 - cosines, 0) + CLOSE)
                marks = int((at >= len(self.space.names)).sum())
                yield min(marks, RICH) + 1, float(near @ self.labels[places] / near.sum()), places, cosines


def _samples(labels: DataFrame, label: str, folds: int, held_out: int, examples: int, calibration: int):
    """Ids with labels of the examples and of the rows to calibrate with."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id").alias("h")
    )
    known = known.where(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != held_out).distinct()
    other = F.pmod(F.col("h"), F.lit(4)) == 0

    def lowest(rows: DataFrame, n: int) -> DataFrame:
        # Nearly all others go before the sort, which then meets about n rows.
        every = rows.count()
        share = F.pmod(F.col("h"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.2 * n / every + 0.001)) if every else F.lit(True)
        return rows.where(share).orderBy("h", "doc_id", "y").limit(n)

    one, zero = (lowest(known.where(~other & (F.col("y") == y)), examples) for y in (1, 0))
    return one.union(zero), lowest(known.where(other), calibration)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, documents with it, toxic ones of them; None counts all documents."""
    seen: dict[str | None, list[int]] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(
            {"term": pa.array(list(seen), pa.string()),
             "n": pa.array([v[0] for v in seen.values()], pa.int64()),
             "ones": pa.array([v[1] for v in seen.values()], pa.int64())}
        )
        seen.clear()
        return out

    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
            for t in [None, *set(terms(text.as_py()))]:
                entry = seen.setdefault(t, [0, 0])
                entry[0] += 1
                entry[1] += y
            if len(seen) > 300_000:
                yield flush()
    yield flush()


def choose_terms(rows: DataFrame, level: float = 0.01, lift: float = 3.0) -> Space:
    """All terms of the rows, and which of them mark the toxic ones. rows: text, y.

    A marking term must occur in a share of the toxic documents that is ``lift`` times
    that of the others, as common words tell next to nothing, however few toxic
    documents have it. All other terms stay in the vectors."""
    counted = rows.mapInArrow(_count_terms, "term string, n long, ones long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    counted = stored(counted, "toxicity-terms").toArrow()  # the examples bound it
    names = counted["term"].to_pylist()
    n, ones = (counted[c].to_numpy().astype(np.float64) for c in ("n", "ones"))
    order = sorted((i for i, t in enumerate(names) if t is not None), key=names.__getitem__)
    every, toxic = (float(v[names.index(None)]) for v in (n, ones)) if None in names else (0.0, 0.0)
    names, n, ones = [names[i] for i in order], n[order], ones[order]
    idf, unseen = np.log((1 + every) / (1 + n)) + 1, math.log(1 + every) + 1
    if not 0 < toxic < every:
        return Space(names, idf, np.zeros(0, dtype=np.int64), unseen)
    spread = n * toxic * (every - n) * (every - toxic)
    chi = np.where(spread > 0, (ones * every - n * toxic) ** 2 * every / np.where(spread > 0, spread, 1), 0.0)
    of_ones, of_others = ones / toxic, (n - ones) / (every - toxic)
    common = np.flatnonzero((ones > 0) & (of_ones >= lift * of_others))
    least = NormalDist().inv_cdf(1 - level / max(1, len(names)) / 2) ** 2
    return Space(names, idf, common[chi[common] >= least], unseen)


class Model:
    """shared: the index, broadcast; curves: for no neighbour and 0 to RICH marking
    terms, knots and values."""

    def __init__(self, shared: Broadcast, curves: list[tuple[np.ndarray, np.ndarray]]):
        self.shared, self.curves = shared, curves

    def score(self, rich: int, vote: float) -> float:
        return float(np.interp(vote, *self.curves[rich]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
    examples: int = 8000,
    calibration: int = 16000,
) -> Model:
    """Learn from docs of doc_id and text, and labels of doc_id and ``label``."""
    ship_package(docs.sparkSession)
    chosen, other = _samples(labels, label, folds, held_out, examples, calibration)
    # Both samples are bounded by the parameters.
    example_rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    space = choose_terms(example_rows.select("text", "y"))
    spaces = docs.sparkSession.sparkContext.broadcast(space)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spaces.value.counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "y": batch.column(2),
                 "at": pa.array([at.tobytes() for at, _, _ in found], pa.binary()),
                 "tf": pa.array([tf.tobytes() for _, tf, _ in found], pa.binary())}
            )

    found = example_rows.mapInArrow(counts, "doc_id long, y int, at binary, tf binary").toArrow()
    vectors = []
    for i, y, at, tf in zip(*(found[c] for c in ("doc_id", "y", "at", "tf"))):
        at, tf = (np.frombuffer(v.as_py(), dtype=np.int32) for v in (at, tf))
        vectors.append((i.as_py(), y.as_py(), *space.vector(at, tf)))
    index = Index.of(space, vectors)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v[:2] for v in shared.value.votes(t.as_py() for t in batch.column(0))]
            yield pa.RecordBatch.from_pydict(
                {"rich": pa.array([r for r, _ in found], pa.int32()),
                 "cell": pa.array([round(v * CELLS) for _, v in found], pa.int32()), "y": batch.column(1)}
            )

    held = docs.join(F.broadcast(other), "doc_id").select("text", "y")
    held = held.mapInArrow(votes, "rich int, cell int, y int").groupBy("rich", "cell")
    cells = held.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).collect()
    curves = []
    for rich in range(RICH + 2):
        own = {r["cell"]: (float(r["n"]), float(r["ones"])) for r in cells if r["rich"] == rich}
        if rich:  # one row at each end: where no row was held, the vote itself counts
            for cell, y in ((0, 0.0), (CELLS, 1.0)):
                n, ones = own.get(cell, (0.0, 0.0))
                own[cell] = n + 1, ones + y
        if own:
            at = sorted(own)
            curves.append(
                isotonic(
                    np.array(at) / CELLS, np.array([own[c][0] for c in at]), np.array([own[c][1] for c in at])
                )
            )
        else:
            curves.append((np.array([0.0]), np.array([0.5])))
    return Model(shared, curves)


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted, evidence (the nearest
    examples: their id, similarity and label)."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    model = fit(source, labels, **settings)
    evidence = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.shared.value
        for batch in batches:
            scores, near = [], []
            for rich, vote, places, cosines in index.votes(t.as_py() for t in batch.column(1)):
                scores.append(model.score(rich, vote))
                near.append(
                    [
                        {"doc_id": int(index.ids[p]), "similarity": float(c), "label": int(index.labels[p])}
                        for p, c in zip(places[:5], cosines)
                    ]
                )
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "score": pa.array(scores, pa.float64()),
                 "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 "evidence": pa.array(near, evidence)}
            )

    return source.mapInArrow(
        run, "doc_id long, score double, predicted int, "
        "evidence array<struct<doc_id: long, similarity: double, label: int>>"
    )
