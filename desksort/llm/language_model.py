"""Score texts with a log-bilinear language model.

The model predicts each token from the three before it: the context vectors, each
weighted per place, add up to a prediction. Every word seen at least ``LEAST`` times
in training has a context vector and a place among the targets of its own, so their
number grows with the corpus; the workers hold ``KNOWN`` of them at most.

A word's probability is a product. First its class: the prediction's product with each
class vector, plus a bias, is that class's score, normalised over all classes. The most
frequent words and the end of a text have a class of their own; the other words share
classes by their last two bytes. Then the word inside its class: the words are the
leaves of a Huffman tree of their counts, each inner node has a vector and a bias, and
the same prediction decides at each node which way to go. One more leaf stands for the
words seen less often, each of which has its add-one share of their training tokens,
with one more share for unseen words. So the probabilities of all words, seen or not,
add up to one, exactly.

It is trained in numpy: classes by noise-contrastive estimation, where a batch shares
its noise classes, so that products of matrices give all scores; the nodes by the
slopes of their decisions. Where contexts are few, a worker normalises each once.

Counts cover all training tokens. The words counted most often (a parameter) and
their counts go to the workers; the rarer ones, whose number grows with the
corpus, are joined. Training reads all training texts: each task trains from the
same start on its own, and the mean is the model: weighted by tokens, and for what
belongs to one word or node by how often the task met it. A task takes together as
many input partitions as hold about ``LESSON`` tokens, so that a table in many small
pieces trains as far as the same table in few.

Tokens: A-Z lower-cased, runs of anything but ASCII white space, then one end.

Defined cases: null texts are empty and consist of the end alone; a null id
counts as the empty text when rows are divided; repeated rows are scored each;
without training rows every token is unseen; no rows give no rows. Extra columns
may have any names.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import crc_of_id, frequent, stored

END = b""  # no word is empty
CONTEXT = 3
OWN = 96  # words with a class of their own, besides the end
SHARED = 61  # classes of the other words
LEAST = 200  # training tokens of a word that has vectors of its own
KNOWN = 150_000  # words whose counts the workers hold
SIZE = 16  # of a vector
NOISE = 48
BATCH = 1024
LATER = 4096  # tokens of a step, once a task has learned from ``SETTLED``
SETTLED = 1 << 18
RATE = 0.15
PAST = 1 / BATCH**2  # where the squared slopes of one word or node begin
BLOCK = 4096  # words or nodes whose sums travel together
MANY = 32  # tasks whose sums are added up in one round
CACHED = 1 << 22  # contexts, if there are no more, whose sums a worker keeps
FLUSH = 400_000
CHUNK = 1024  # tokens normalised together: their scores of all classes stay in a core's cache
TOGETHER = 131_072  # tokens scored together
LESSON = 4_000_000  # training tokens of a task, where partitions are smaller


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def shared_class(word: bytes) -> int:
    return int.from_bytes(word[-2:], "big") % SHARED


def shared_class_column(word: Column) -> Column:
    return (F.conv(F.hex(F.substring(word, -2, 2)), 16, 10).cast("long") % SHARED).cast("int")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(
            {"word": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())}
        )
        found.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            found.update(tokens(text.as_py()))
            if len(found) > FLUSH:
                yield flush()
    yield flush()


class _Numbers(dict):
    """A word's number; for others, -1 less their class."""

    def __missing__(self, word: bytes) -> int:
        return -1 - shared_class(word)


class Paths:
    """The ways to the leaves of all classes' Huffman trees: the inner nodes that each
    leaf's way meets, and the turn it takes there, 1 or -1."""

    def __init__(self, trees: list[list[tuple[float, int]]], leaves: int):
        """trees: per class its leaves, as weight and number."""
        ways: list = [()] * leaves
        bias = []
        for tree in trees:
            heap = [(weight, leaf, leaf) for weight, leaf in tree]
            heapq.heapify(heap)
            below, order = {}, leaves
            while len(heap) > 1:
                (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
                below[order] = (len(bias), left, right)
                bias.append(np.log(a / b))  # what the counts alone say
                heapq.heappush(heap, (a + b, order, order))
                order += 1
            going = [(heap[0][2], ())] if heap else []
            while going:
                at, way = going.pop()
                if at < leaves:
                    ways[at] = way
                else:
                    node, left, right = below[at]
                    going += [(left, (*way, node + 1)), (right, (*way, -node - 1))]
        steps = np.fromiter((x for way in ways for x in way), dtype=np.int32)
        # The last leaf is none, for words with a class of their own.
        self.sizes = np.array([*map(len, ways), 0], dtype=np.uint8)
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.nodes, self.turns = np.abs(steps) - 1, np.sign(steps).astype(np.float32)
        self.bias = np.array(bias, dtype=np.float32)

    def cells(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The places of the leaves, those with the longest ways first, how many ways have
        a first, a second and so on node, and the nodes and turns: all first ones, then
        all second ones, each in that order (-1, no leaf, has none)."""
        sizes = self.sizes.take(leaves, mode="wrap")
        order = np.argsort(~sizes, kind="stable")
        width = int(sizes[order[0]])
        with_one = np.searchsorted(~sizes.take(order), 255 - np.arange(width), side="left").astype(np.int64)
        first = self.starts.take(leaves.take(order[: with_one[0]] if width else order[:0]), mode="wrap")
        at = np.concatenate([first[:n] + d for d, n in enumerate(with_one)]) if width else first
        return order, with_one, self.nodes.take(at), self.turns.take(at)


def _levels(counts: np.ndarray) -> list[slice]:
    ends = np.cumsum(counts)
    return [slice(end - n, end) for n, end in zip(counts, ends)]


WIDTH = 2 * SIZE + 3  # of a word's sums: its vector and weight, its node's vector, bias and weight


class Vocabulary:
    """Counts that every worker holds: of the known words and of the classes.

    A symbol is what a token is to the model: first the classes, then what stands before
    a text, then the words with vectors of their own. Leaves are these words and then the
    shared classes' rarer words."""

    def __init__(self, words: list[bytes], counts: list[int], shared: np.ndarray, total: int, distinct: int):
        """words: most frequent first; shared: tokens and words of each shared class."""
        self.words = words
        self.counts = np.array([*counts, 0], dtype=np.float64)
        self.total, self.distinct = total, distinct
        own = [END, *[w for w in words if w != END][:OWN]]
        place = {w: i for i, w in enumerate(own)}
        self.classes = len(own) + SHARED
        self.first_shared = len(own)
        self.of = np.array([place[w] if w in place else len(own) + shared_class(w) for w in words] or [0], dtype=np.int16)
        freq = np.ones(self.classes)
        for w, n in zip(words, counts):
            if w in place:
                freq[place[w]] += n
        freq[self.first_shared :] += shared[:, 0]
        self.share = freq / freq.sum()
        taught = [i for i, (w, n) in enumerate(zip(words, counts)) if w not in place and n >= LEAST]
        self.taught = len(taught)
        rarer = shared.astype(np.float64)  # tokens and words without vectors, by class
        trees: list = [[] for _ in range(SHARED)]
        for leaf, i in enumerate(taught):
            at = self.of[i] - self.first_shared
            rarer[at] -= counts[i], 1
            trees[at].append((counts[i] + 1, leaf))
        left = rarer.sum(axis=1) + 1
        for at, tree in enumerate(trees):
            tree.append((left[at], self.taught + at))
        self.paths = Paths(trees, self.taught + SHARED)
        self.symbol = self.of.astype(np.int32)
        self.symbol[taught] = self.classes + 1 + np.arange(self.taught)
        # Class and leaf of each symbol; words with a class of their own have no leaf.
        self.class_by_symbol = np.concatenate([np.arange(self.classes + 1, dtype=np.int16), self.of[taught]])
        self.leaf_by_symbol = np.full(len(self.class_by_symbol), -1, dtype=np.int32)
        self.leaf_by_symbol[self.first_shared : self.classes] = self.taught + np.arange(SHARED)
        self.leaf_by_symbol[self.classes + 1 :] = np.arange(self.taught)
        # log10 of what a token of a class's rarer words is divided by; 0 for the others.
        self.divisor = np.zeros(len(self.class_by_symbol))
        self.divisor[self.first_shared : self.classes] = np.log10(left)
        self._numbers = None

    def __getstate__(self):
        return self.__dict__ | {"_numbers": None}

    def numbers(self, found: list[bytes]) -> np.ndarray:
        if self._numbers is None:
            self._numbers = _Numbers(zip(self.words, range(len(self.words))))
        return np.fromiter(map(self._numbers.__getitem__, found), dtype=np.int64, count=len(found))

    def symbols(self, numbers: np.ndarray) -> np.ndarray:
        """Symbols, also of unknown words; the end is class 0 even if unseen."""
        known = self.symbol[np.maximum(numbers, 0)]
        return np.where(numbers >= 0, known, self.first_shared - 1 - numbers).astype(np.int32)


def with_context(classes: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray]:
    """Targets of all texts in a row, and the classes before each; ``start``
    stands before a text's first token."""
    pad = np.full(CONTEXT, start, dtype=np.int16)
    flat = np.concatenate([x for own in classes for x in (pad, own)])
    sizes = np.array([len(own) for own in classes])
    at = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(classes) + 1) * CONTEXT, sizes)
    return flat[at], np.stack([flat[at - j] for j in range(1, CONTEXT + 1)], axis=1)


class Model:
    """vectors of context symbols, weights per place, vectors and biases of target
    classes, vectors of the trees' nodes with their biases at the end."""

    def __init__(self, context, places, target, bias, nodes=None):
        self.context, self.places, self.target, self.bias = context, places, target, bias
        self.nodes = np.zeros((0, SIZE + 1), dtype=np.float32) if nodes is None else nodes
        self.forget()

    def forget(self) -> None:
        """To be called when parts change: drops what is kept between calls."""
        self._sums = self._tables = None

    def __getstate__(self):
        return self.__dict__ | {"_sums": None, "_tables": None}

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 5, node_bias: np.ndarray | None = None) -> Model:
        """A tree has one inner node per word with vectors of its own."""
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(scale=0.1, size=shape).astype(np.float32)
        places = np.ones((CONTEXT, SIZE), dtype=np.float32) / np.arange(1, CONTEXT + 1, dtype=np.float32)[:, None]
        context, target = small(len(share) + 1, SIZE), small(len(share), SIZE)
        taught = 0 if node_bias is None else len(node_bias)
        context = np.concatenate([context, small(taught, SIZE)])
        nodes = np.zeros((taught, SIZE + 1), dtype=np.float32)
        if taught:
            nodes[:, -1] = node_bias
        return cls(context, places, target, np.log(share).astype(np.float32), nodes)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.places, self.target, self.bias, self.nodes]

    def predictions(self, context: np.ndarray) -> np.ndarray:
        return sum(self.context.take(context[:, j], axis=0) * self.places[j] for j in range(CONTEXT))

    def _normalisers(self, context: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all classes; those of other contexts than before
        are computed and kept."""
        if self._sums is None:
            self._sums = np.full(len(self.context) ** CONTEXT, np.nan)
        number = np.zeros(len(context), dtype=np.int64)
        for j in range(CONTEXT):
            number = number * len(self.context) + context[:, j]
        out = self._sums[number]
        lacking = np.flatnonzero(np.isnan(out))
        if len(lacking):
            new, first = np.unique(number[lacking], return_index=True)
            for a in range(0, len(new), CHUNK):
                scores = self.predictions(context[lacking[first[a : a + CHUNK]]]) @ self.target.T + self.bias
                most = scores.max(axis=1)
                scores -= most[:, None]
                np.exp(scores, out=scores)
                self._sums[new[a : a + CHUNK]] = most + np.log(scores.sum(axis=1))
            out = self._sums[number]
        return out

    def log10(
        self, targets: np.ndarray, context: np.ndarray, leaves: np.ndarray | None = None, paths: Paths | None = None
    ) -> np.ndarray:
        """Normalised log10 probabilities of the target classes and, inside them, leaves."""
        if len(self.nodes) or len(self.context) ** CONTEXT > CACHED:
            out = np.empty(len(targets))
            for a in range(0, len(targets), CHUNK):
                some = slice(a, a + CHUNK)
                guess = self.predictions(context[some])
                scores = guess @ self.target.T
                scores += self.bias
                own = scores[np.arange(len(guess)), targets[some]]
                # One number for all rows, unless they lie far apart.
                most = scores.max()
                if most - scores.max(axis=1).min() > 60:
                    most = scores.max(axis=1)[:, None]
                scores -= most
                np.exp(scores, out=scores)
                out[some] = own - np.ravel(most) - np.log(scores @ np.ones(len(self.bias), dtype=np.float32))
                if leaves is not None:
                    out[some] += self._inside(guess, leaves[some], paths)
            return out / np.log(10)
        if self._tables is None:
            self._tables = [(self.context * self.places[j]) @ self.target.T for j in range(CONTEXT)]
        own = self.bias[targets].astype(np.float64)
        for j, table in enumerate(self._tables):
            own += table[context[:, j], targets]
        return (own - self._normalisers(context)) / np.log(10)

    def _inside(self, guess: np.ndarray, leaves: np.ndarray, paths: Paths) -> np.ndarray:
        """Logarithms of the leaves' probabilities inside their classes."""
        order, counts, nodes, turns = paths.cells(leaves)
        out = np.zeros(len(leaves))
        if not len(nodes):
            return out
        said = np.einsum("ij,ij->i", _met(guess, order, counts), self.nodes.take(nodes, axis=0))
        said *= turns
        logs = np.log(1 / (1 + np.exp(-np.clip(said, -30, 30))))
        sums = np.zeros(counts[0])
        for n, level in zip(counts, _levels(counts)):
            sums[:n] += logs[level]
        out[order[: counts[0]]] = sums
        return out


def _met(guess: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The predictions, with a one at the end, beside the nodes of ``Paths.cells``."""
    sorted_ = np.ones((counts[0], SIZE + 1), dtype=np.float32)
    sorted_[:, :-1] = guess.take(order[: counts[0]], axis=0)
    return np.concatenate([sorted_[:n] for n in counts])


def _added(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that go to the same place."""
    order = np.argsort(at, kind="stable")
    places = at[order]
    starts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    out = np.zeros((n, rows.shape[1]), dtype=np.float32)
    out[places[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


def _grouped(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places, the sums of the rows that go to each, and how many these are."""
    # Two rounds by 16 bits, for which numpy has a sort in linear time.
    order = np.argsort((at & 0xFFFF).astype(np.uint16), kind="stable")
    if len(at) and at.max() > 0xFFFF:
        order = order[np.argsort((at >> 16).astype(np.uint16)[order], kind="stable")]
    places = at[order]
    starts = np.flatnonzero(np.append(True, places[1:] != places[:-1])[: len(places)])
    if not len(starts):
        return places, rows[:0], starts
    sums = np.add.reduceat(rows.take(order, axis=0), starts, axis=0)
    return places[starts], sums, np.diff(starts, append=len(places))


class Trainer:
    """Noise-contrastive estimation of the classes and slopes of the nodes' decisions,
    with steps scaled by past gradients."""

    def __init__(self, model: Model, share: np.ndarray, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.edges = np.cumsum(share)
        self.expected = np.log(NOISE * share).astype(np.float32)
        self.past = [np.full(p.shape, 1e-2, dtype=np.float32) for p in model.parts()]
        for past in (self.past[0][len(share) + 1 :], self.past[4]):
            past[:] = PAST
        # How often each context symbol and each node was met.
        self.met, self.met_nodes = np.zeros(len(model.context)), np.zeros(len(model.nodes))

    def _move(self, which: int, gradient: np.ndarray, at: np.ndarray | None = None) -> None:
        """A step of a part, or of its rows ``at``."""
        part, past = self.model.parts()[which], self.past[which]
        if at is None:
            past += gradient * gradient
            part += RATE * gradient / np.sqrt(past)
            return
        squares = gradient * gradient
        squares += past.take(at, axis=0)
        gradient *= np.float32(RATE)
        gradient /= np.sqrt(squares)
        gradient += part.take(at, axis=0)
        # Rows are written as one piece each.
        piece = np.dtype((np.void, part.strides[0]))
        past.view(piece)[:, 0][at] = squares.view(piece)[:, 0]
        part.view(piece)[:, 0][at] = gradient.view(piece)[:, 0]

    def _decide(self, guess: np.ndarray, leaves: np.ndarray, paths: Paths, pull: np.ndarray) -> None:
        """Moves the nodes on the leaves' ways; adds to ``pull`` what they say of the predictions."""
        order, counts, nodes, turns = paths.cells(leaves)
        if not len(nodes):
            return
        rows, vectors = _met(guess, order, counts), self.model.nodes.take(nodes, axis=0)
        said = np.einsum("ij,ij->i", rows, vectors)
        said *= turns
        push = (turns / (1 + np.exp(np.clip(said, -30, 30))))[:, None]
        rows *= push
        vectors *= push
        sums = np.zeros((counts[0], SIZE + 1), dtype=np.float32)
        for n, level in zip(counts, _levels(counts)):
            sums[:n] += vectors[level]
        pull[order[: counts[0]]] += sums[:, :-1]
        at, gradient, times = _grouped(rows, nodes)
        gradient /= np.float32(len(guess))
        self.met_nodes[at] += times
        self._move(4, gradient, at)

    def step(
        self, targets: np.ndarray, context: np.ndarray, leaves: np.ndarray | None = None, paths: Paths | None = None
    ) -> None:
        m = self.model
        m.forget()
        drawn = np.searchsorted(self.edges[:-1], self.rng.random(NOISE))
        n, classes = len(targets), len(m.bias)
        before = [m.context.take(context[:, j], axis=0) for j in range(CONTEXT)]
        guess = sum(vectors * place for vectors, place in zip(before, m.places))
        own, noise = m.target.take(targets, axis=0), m.target[drawn]
        true = np.einsum("ij,ij->i", guess, own) + m.bias[targets] - self.expected[targets]
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        # In place, as memory for so many numbers would be new each time.
        down = guess @ -noise.T
        down -= m.bias[drawn] - self.expected[drawn]
        np.minimum(down, 30, out=down)
        np.exp(down, out=down)
        down += 1
        np.divide(-1, down, out=down)
        pull = down @ noise
        own *= up[:, None]
        pull += own
        at_target = np.concatenate([targets, drawn.astype(np.int16)])
        # The last column is the gradient of the bias.
        rows = np.empty((n + NOISE, SIZE + 1), dtype=np.float32)
        np.multiply(up[:, None], guess, out=rows[:n, :-1])
        rows[:n, -1] = up
        rows[n:, :-1] = down.T @ guess
        rows[n:, -1] = down.sum(axis=0)
        to_target = _added(rows, at_target, classes) / np.float32(n)
        if leaves is not None:
            self._decide(guess, leaves, paths, pull)
        # What pulls at each context symbol, place by place.
        at, to_context, times = _grouped(
            np.concatenate([pull * place for place in m.places]), context.T.ravel().astype(np.int32)
        )
        to_places = np.stack([np.einsum("ij,ij->j", pull, vectors) for vectors in before])
        to_context /= np.float32(n)
        self.met[at] += times
        self._move(0, to_context, at)
        for which, gradient in ((1, to_places / np.float32(n)), (2, to_target[:, :-1]), (3, to_target[:, -1])):
            self._move(which, gradient)


def _train(texts: DataFrame, vocabulary, start: Model) -> Model:
    """The mean of models that partitions train from the same start.

    What all tokens share travels as one row of a task; what belongs to words or nodes
    in rows of ``BLOCK``, each weighted by how often the task met it."""
    import pandas as pd

    sent = texts.sparkSession.sparkContext.broadcast(start)
    common = len(start.bias) + 1  # symbols that are no words
    parts = 1 if texts.rdd.getNumPartitions() <= MANY else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        model = Model(*[p.copy() for p in sent.value.parts()])
        part = TaskContext.get().partitionId()
        trainer = Trainer(model, words.share, 1000 + part)
        trained, waiting, held = 0, [], 0

        def learn(symbols: list[np.ndarray]) -> None:
            targets, context = with_context(symbols, words.classes)
            mixed = trainer.rng.permutation(len(targets))
            classes, leaves = words.class_by_symbol[targets], words.leaf_by_symbol[targets]
            size = BATCH if trained < SETTLED else LATER
            for a in range(0, len(targets), size):
                some = mixed[a : a + size]
                trainer.step(classes[some], context[some], leaves[some], words.paths)

        def row(block: int, ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            cells = {"part": part % parts, "block": block, "tokens": trained, "ids": ids.tobytes(), "sums": sums.tobytes()}
            return pa.RecordBatch.from_pylist([cells], schema)

        for batch in batches:
            for text in batch.column(0):
                waiting.append(words.symbols(words.numbers(tokens(text.as_py()))))
                held += len(waiting[-1])
                if held > 64 * BATCH:
                    learn(waiting)
                    trained, waiting, held = trained + held, [], 0
        if held:
            learn(waiting)
            trained += held
        if trained:
            flat = np.concatenate([p.ravel() for p in (model.context[:common], *model.parts()[1:4])])
            yield row(-1, np.zeros(0, dtype=np.uint16), flat.astype(np.float64) * trained)
            own = [(model.context[common:], trainer.met[common:]), (model.nodes, trainer.met_nodes)]
            own = [x for p, met in own for x in (p * met[:, None].astype(np.float32), met[:, None].astype(np.float32))]
            own = np.concatenate(own, axis=1)
            for at in range(0, len(own), BLOCK):
                some = own[at : at + BLOCK]
                ids = np.flatnonzero((some[:, SIZE] > 0) | (some[:, -1] > 0))
                yield row(at // BLOCK, ids.astype(np.uint16), some[ids])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["block"].iloc[0] < 0:
            ids, total = np.zeros(0, dtype=np.uint16), np.sum([np.frombuffer(s) for s in rows["sums"]], axis=0)
        else:
            total = np.zeros((BLOCK, WIDTH))
            for ids, sums in zip(rows["ids"], rows["sums"]):
                total[np.frombuffer(ids, dtype=np.uint16)] += np.frombuffer(sums, dtype=np.float32).reshape(-1, WIDTH)
            ids = np.flatnonzero(total.any(axis=1)).astype(np.uint16)
            total = total[ids].astype(np.float32)
        return pd.DataFrame({
            "part": rows["part"].iloc[:1], "block": rows["block"].iloc[:1], "tokens": [rows["tokens"].sum()],
            "ids": [ids.tobytes()], "sums": [total.tobytes()],
        })

    kinds = "part int, block int, tokens long, ids binary, sums binary"
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("tokens", pa.int64()), ("ids", pa.binary()), ("sums", pa.binary())
    ])
    sums = texts.mapInArrow(run, kinds).groupBy("part", "block").applyInPandas(added, kinds)
    if parts > 1:
        sums = sums.groupBy("block").applyInPandas(added, kinds)
    own, nodes, shared = start.context[common:].copy(), start.nodes.copy(), None
    for r in sums.collect():  # classes and known words bound it
        if r["block"] < 0:
            shared = np.frombuffer(r["sums"]) / r["tokens"]
            continue
        at = np.frombuffer(r["ids"], dtype=np.uint16).astype(np.intp) + r["block"] * BLOCK
        cells = np.frombuffer(r["sums"], dtype=np.float32).reshape(-1, WIDTH)
        # What no task met stays as it was.
        for part, vectors, met in ((own, cells[:, :SIZE], cells[:, SIZE]), (nodes, cells[:, SIZE + 1 : -1], cells[:, -1])):
            part[at[met > 0]] = vectors[met > 0] / met[met > 0, None]
    if shared is None:
        return start
    out, at = [], 0
    for p in (start.context[:common], *start.parts()[1:4]):
        out.append(shared[at : at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return Model(np.concatenate([out[0], own]), *out[1:], nodes)


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: binary, n: long>>"
)


def _score(vocabulary, model):
    """Per text what known words give, and the words that the worker lacks."""
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, m = vocabulary.value, model.value
        begin = TaskContext.get().partitionId() << 36
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                first, symbols, rare, known, base, inside = at, [], [], [], [], []
                held = 0
                while at < batch.num_rows and held < TOGETHER:
                    found = tokens(batch.column(2)[at].as_py())
                    numbers = words.numbers(found)
                    own = words.symbols(numbers)
                    if numbers[-1] < 0:  # an end that was never seen
                        own[-1] = 0
                    lacking = Counter([found[i] for i in np.flatnonzero(numbers < 0).tolist() if found[i] != END])
                    rare.append([{"word": w, "n": n} for w, n in lacking.items()])
                    logs = np.log10(words.counts[np.maximum(numbers, -1)] + 1)
                    logs[numbers < 0] = 0.0
                    known.append(int((numbers >= 0).sum()))
                    base.append(float(logs.sum()))
                    rarer = (own >= words.first_shared) & (own < words.classes)
                    inside.append(float(logs[rarer].sum() - words.divisor[own].sum()))
                    symbols.append(own)
                    held += len(own)
                    at += 1
                targets, context = with_context(symbols, words.classes)
                sizes = np.array([len(c) for c in symbols])
                logs = m.log10(words.class_by_symbol[targets], context, words.leaf_by_symbol[targets], words.paths)
                sums = np.add.reduceat(logs, np.append(0, np.cumsum(sizes)[:-1]))
                rows = np.arange(begin + first, begin + at)
                yield pa.RecordBatch.from_pydict(
                    {"row": rows, "doc_id": batch.column(0).slice(first, at - first),
                     "held_out": batch.column(1).slice(first, at - first), "n_tokens": sizes,
                     "n_known": pa.array(known, pa.int64()),
                     "base": np.array(base) - sizes * np.log10(words.total + words.distinct + 1),
                     "score": sums + np.array(inside), "rare": pa.array(rare, rare_type)}
                )
            begin += batch.num_rows

    return run


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 7,
    held_out: int = 2,
    known: int = KNOWN,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base
    (add-one word frequencies) and score (the model), both log10."""
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.pmod(crc_of_id(F.col(doc_id)), F.lit(folds)) == held_out).alias("held_out"),
        F.col(text).alias("text"),
    )
    train = source.where(~F.col("held_out")).select("text")
    counted = train.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counted, "lm-counts")
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    is_known = frequent(counts, "n", known) | (F.length("word") == 0)  # the end always
    top = counts.where(is_known).collect()  # a parameter bounds it
    top.sort(key=lambda r: (-r["n"], r["word"]))
    words = [bytes(r["word"]) for r in top]
    own = [END, *[w for w in words if w != END][:OWN]]
    classed = counts.where(~F.col("word").isin(own)).groupBy(shared_class_column(F.col("word")).alias("c"))
    shared = np.zeros((SHARED, 2))
    for r in classed.agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        shared[r["c"]] = r["n"], r["words"]
    vocabulary = Vocabulary(words, [r["n"] for r in top], shared, sums["total"] or 0, sums["distinct"])
    sent = spark.sparkContext.broadcast(vocabulary)
    lessons = max(1, -(-vocabulary.total // LESSON))
    model = _train(train.coalesce(lessons), sent, Model.start(vocabulary.share, node_bias=vocabulary.paths.bias))
    found = stored(source.mapInArrow(_score(sent, spark.sparkContext.broadcast(model)), SCORED), "lm-scored")
    # Words of the corpus that are not known to every worker.
    rarer = counts.where(~is_known)
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    more = (
        rare.join(rarer, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return found.drop("rare").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
