"""Mine collocations: exact counts of phrases in counting quotient filters.

Words that occur often enough to be part of a candidate get ids per language, most
frequent first. A phrase is its ids, packed into a key of two halves. An invertible
permutation of that key (see ``permuted``) spreads the keys evenly; its highest bits
are the shard and the quotient, all others the remainder, so a filter loses nothing:
a slot and a remainder give back the phrase. A task counts in such filters, cuts them
by shard and sends them; the filters of a shard, which are sorted, are merged in one
group. A phrase in every text is one counter per filter, whatever its share.

Lengths are counted one after the other. A phrase can only be frequent where both its
longest parts are, so the quotients that a length's frequent phrases occupy are sent
to the tasks of the next as bits (``MOST_BITS`` at most), which pass over the rest.
Bits that different phrases share only let more be counted.

``MOST_WORDS`` words get ids. The others that are frequent enough, if there are any,
are marked by a bit of their hash, and phrases with such a word are counted as text;
results do not depend on the bound.

Defined cases: null texts are empty; null languages are ``und``, and one with that
name; only A to Z are lower-cased; pieces end at ``. , ; : ! ?`` and line breaks and
words at spaces and tabs; repeated rows count each; languages without candidates and
empty tables give no rows. Only the named columns are read, so extra columns may have
any names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import frequent, met, stored

LEAST = 30
LONGEST = 4
TOP = 2000
CONTAINED = 80  # percent
SCALE = 2_000_000
MOST_WORDS = 262_144
MOST_BITS = 27  # as a power of two: 16 MB
FLUSH = 400_000  # distinct words that a counting task holds
GROUP = 2_000_000  # bytes of text that are cut together
ROW = 512  # words in a row of ids, and up to the next gap
CHUNK = 1_000_000  # words whose phrases are counted together
PER_SHARD = 1_000_000  # phrases that a shard is meant to hold
MOST_SHARDS = 15  # as a power of two
SALTS = 64
SLICE = 32_768  # bits that are put together in one row

GAP = 0xFF  # no byte of UTF-8


def _table() -> bytes:
    out = list(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        out[upper] = upper + 32
    for end in b".,;:!?\x0a\x0b\x0c\x0d":
        out[end] = GAP
    return bytes(out)


TABLE = _table()


def words_of(texts: list[str | None]) -> list[bytes]:
    """The words of all texts in order; a lone ``GAP`` stands between pieces."""
    # Texts are joined by a line break, which ends a piece.
    data = "\n".join(t or "" for t in texts).encode().translate(TABLE)
    return data.replace(b"\xff", b" \xff ").split()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str | None]]]:
    """The texts of a batch by language, at most ``GROUP`` bytes and one text at a time."""
    found: dict[str, list] = {}
    size = 0
    for lang, text in zip(batch.column(0), batch.column(1)):
        found.setdefault(lang.as_py(), []).append(text.as_py())
        size += len(found[lang.as_py()][-1] or "")
        if size > GROUP:
            yield from found.items()
            found, size = {}, 0
    yield from found.items()


# --- counting words ------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(b"\xff", None)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(found), pa.string()),
                "word": pa.array(list(found), pa.binary()).cast(pa.string()),
                "n": pa.array(list(found.values()), pa.int64()),
            })
        counts.clear()

    for batch in batches:
        for lang, texts in _by_lang(batch):
            counts.setdefault(lang, Counter()).update(words_of(texts))
        if sum(map(len, counts.values())) > FLUSH:
            yield from flush()
    yield from flush()


def word_counts(source: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words of ``source`` (lang, text)."""
    counted = source.mapInArrow(_count_words, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


# --- the filter ----------------------------------------------------------


def _mixed(x: np.ndarray, round_: int) -> np.ndarray:
    """64 bits that depend on all bits of ``x``."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (round_ + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ROUNDS = 4


def permuted(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of keys of two halves of ``half`` bits each (a Feistel net)."""
    mask = np.uint64((1 << half) - 1)
    for i in range(ROUNDS):
        high, low = low, high ^ (_mixed(low, i) & mask)
    return high, low


def restored(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permuted``."""
    mask = np.uint64((1 << half) - 1)
    for i in reversed(range(ROUNDS)):
        high, low = low ^ (_mixed(high, i) & mask), high
    return high, low


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with their counts added up."""
    order = np.argsort(high)
    same = high[order]
    if (same[1:] == same[:-1]).any():
        # Equal first halves are nearly always equal keys; where not, the second decides.
        tied = low[order]
        if ((same[1:] == same[:-1]) & (tied[1:] != tied[:-1])).any():
            order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.ones(len(high), dtype=bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    starts = np.flatnonzero(first)
    if counts is None:
        total = np.diff(np.append(starts, len(high)))
    else:
        total = np.add.reduceat(counts[order], starts) if len(starts) else counts
    return high[starts], low[starts], total


def _narrow(values: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` of each value, in whole bytes."""
    width = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widened(data: memoryview, n: int, bits: int) -> np.ndarray:
    width = -(-bits // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(n, width)
    return out.view("<u8").reshape(n)


def write_filter(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int, half: int) -> bytes:
    """A filter of sorted keys, of which ``high`` has ``bits`` bits below its shard.

    About as many slots as keys. For each slot the number of its keys in unary (a one
    per key, then a zero), then the remainders in slot order, then counters of one
    byte, where 255 stands for one of the long counters at the end.
    """
    n = len(high)
    slot_bits = min(bits, max(0, n.bit_length() - 1))
    rest = bits - slot_bits
    slots = (high >> np.uint64(rest)).astype(np.int64) if slot_bits else np.zeros(n, dtype=np.int64)
    ones = np.zeros(n + (1 << slot_bits), dtype=np.uint8)
    ones[slots + np.arange(n)] = 1
    remainder = high & np.uint64((1 << rest) - 1)
    long = counts >= 255
    head = np.array([n, slot_bits, long.sum()], dtype="<i8").tobytes()
    return b"".join([
        head, np.packbits(ones).tobytes(), _narrow(remainder, rest), _narrow(low, half),
        np.where(long, 255, counts).astype(np.uint8).tobytes(), counts[long].astype("<i8").tobytes(),
    ])


def read_filter(data: bytes, bits: int, half: int) -> tuple[np.ndarray, ...]:
    """The keys and counts that ``write_filter`` was given."""
    view = memoryview(data)
    n, slot_bits, n_long = np.frombuffer(view[:24], dtype="<i8").tolist()
    rest, at = bits - slot_bits, 24
    size = n + (1 << slot_bits)

    def take(length: int) -> memoryview:
        nonlocal at
        at += length
        return view[at - length : at]

    ones = np.unpackbits(np.frombuffer(take(-(-size // 8)), dtype=np.uint8), count=size)
    places = np.flatnonzero(ones)
    slots = (places - np.arange(n)).astype(np.uint64)
    remainder = _widened(take(n * -(-rest // 8)), n, rest)
    low = _widened(take(n * -(-half // 8)), n, half)
    counts = np.frombuffer(take(n), dtype=np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * n_long), dtype="<i8")
    return (slots << np.uint64(rest)) | remainder, low, counts


# --- phrases -------------------------------------------------------------


class Layout:
    """Where the bits of a phrase's key lie."""

    def __init__(self, size: int, n_ids: int, tokens: int, least: int):
        self.size = size
        self.word_bits = max(1, int(n_ids).bit_length())
        self.half = -(-size * self.word_bits // 2)
        wanted = max(0, (tokens // PER_SHARD).bit_length())
        self.shard_bits = min(wanted, MOST_SHARDS, max(0, self.half - 3))
        # Eight times as many bits as there can be frequent phrases, up to the bound.
        marks = max(self.shard_bits + 3, (8 * tokens // least).bit_length())
        self.mark_bits = min(marks, MOST_BITS, self.half)

    def keys(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The permuted keys of the phrases that start at these places."""
        w, half = self.word_bits, self.half
        parts = [ids[starts + i].astype(np.uint64) for i in range(self.size)]
        first, second = parts[: self.size // 2], parts[self.size // 2 :]
        # Each half holds half of the bits: of three words, the second is cut in two.
        if self.size == 3:
            kept, middle = half - w, parts[1]
            high = (parts[0] << np.uint64(kept)) | (middle >> np.uint64(w - kept))
            low = ((middle & np.uint64((1 << (w - kept)) - 1)) << np.uint64(w)) | parts[2]
        else:
            high, low = (self._packed(p) for p in (first, second))
        return permuted(high, low, half)

    def _packed(self, parts: list[np.ndarray]) -> np.ndarray:
        out = parts[0]
        for part in parts[1:]:
            out = (out << np.uint64(self.word_bits)) | part
        return out

    def ids(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        """The ids of the words of permuted keys."""
        w, half = self.word_bits, self.half
        high, low = restored(high, low, half)
        mask = np.uint64((1 << w) - 1)
        if self.size == 3:
            kept = half - w
            middle = ((high & np.uint64((1 << kept) - 1)) << np.uint64(w - kept)) | (low >> np.uint64(w))
            return [high >> np.uint64(kept), middle & mask, low & mask]
        if self.size == 2:
            return [high, low]
        return [high >> np.uint64(w), high & mask, low >> np.uint64(w), low & mask]

    def marks(self, high: np.ndarray) -> np.ndarray:
        return (high >> np.uint64(self.half - self.mark_bits)).astype(np.int64)


def _marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _starts(ids: np.ndarray, shorter: Layout | None, bits: np.ndarray | None, size: int) -> np.ndarray:
    """Places where a phrase of ``size`` words starts that can be frequent."""
    known = ids >= 0
    if shorter is None:
        return np.flatnonzero(known[:-1] & known[1:])
    whole = known[: len(ids) - size + 2].copy()
    for i in range(1, size - 1):
        whole &= known[i : len(ids) - size + 2 + i]
    starts = np.flatnonzero(whole)
    hit = np.zeros(len(ids), dtype=bool)
    hit[starts[_marked(bits, shorter.marks(shorter.keys(ids, starts)[0]))]] = True
    return np.flatnonzero(hit[:-1] & hit[1:])


def count_phrases(tokens: DataFrame, layout: Layout, shorter: Layout | None, bits, words, least: int) -> DataFrame:
    """``lang, phrase, size, n`` of frequent phrases, and rows with the bits of a shard.

    ``tokens`` has arrays of ids; ``bits`` and ``words`` are broadcasts."""
    size, half, shard_bits = layout.size, layout.half, layout.shard_bits
    below = half - shard_bits  # bits of the high half below the shard

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if bits is None else np.frombuffer(bits.value, dtype=np.uint8)
        for batch in batches:
            for ids in _chunks(b"".join(batch.column(0).to_pylist())):
                if len(ids) < size:
                    continue
                starts = _starts(ids, shorter, marks, size)
                if not len(starts):
                    continue
                high, low, n = summed(*layout.keys(ids, starts))
                shard = (high >> np.uint64(below)).astype(np.int64)
                edges = np.flatnonzero(np.diff(shard)) + 1
                inside = high & np.uint64((1 << below) - 1)
                parts = [
                    write_filter(inside[a:b], low[a:b], n[a:b], below, half)
                    for a, b in zip(np.append(0, edges), np.append(edges, len(shard)))
                ]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(shard[np.append(0, edges)], pa.int32()), "part": pa.array(parts, pa.binary()),
                })

    def merge(table: pa.Table) -> pa.Table:
        found = [read_filter(part.as_py(), below, half) for part in table.column("part")]
        high, low, n = summed(*(np.concatenate(c) for c in zip(*found)))
        del found
        kept = n >= least
        shard = table.column("shard")[0].as_py()
        high, low, n = high[kept] | np.uint64(shard << below), low[kept], n[kept]
        span = layout.mark_bits - shard_bits
        mine = np.zeros(1 << span, dtype=np.uint8)
        mine[layout.marks(high) - (shard << span)] = 1
        names = words.value
        columns = [ids.astype(np.int64).tolist() for ids in layout.ids(high, low)]
        phrases = [b" ".join(names[i][1] for i in ids).decode() for ids in zip(*columns)]
        langs = [names[i][0] for i in columns[0]]
        return pa.table({
            "shard": pa.array([None] * len(n) + [shard], pa.int32()),
            "bits": pa.array([None] * len(n) + [np.packbits(mine).tobytes()], pa.binary()),
            "lang": pa.array(langs + [None], pa.string()),
            "phrase": pa.array(phrases + [None], pa.string()),
            "n": pa.array(n.tolist() + [None], pa.int64()),
        })

    filters = tokens.mapInArrow(count, "shard int, part binary")
    merged = filters.groupBy("shard").applyInArrow(merge, "shard int, bits binary, lang string, phrase string, n long")
    return stored(merged.withColumn("size", F.lit(size)), f"phrases-{size}")


def _bits(spark: SparkSession, counted: DataFrame, layout: Layout):
    """The occupied quotients of a length, as one broadcast of bounded size."""
    span = layout.mark_bits - layout.shard_bits
    out = np.zeros(1 << max(0, layout.mark_bits - 3), dtype=np.uint8)
    for row in counted.where("shard is not null").select("shard", "bits").collect():
        piece = np.frombuffer(row["bits"], dtype=np.uint8)
        if span >= 3:
            out[row["shard"] << (span - 3) :][: len(piece)] = piece
        else:
            at = row["shard"] << span
            out[at >> 3] |= piece[0] >> (at & 7)
    return spark.sparkContext.broadcast(out.tobytes())


def _chunks(data: bytes) -> Iterator[np.ndarray]:
    """The ids of many rows in parts of about ``CHUNK``, cut where no phrase goes on."""
    ids = np.frombuffer(data, dtype="<i4")
    while len(ids):
        end = CHUNK + int((ids[CHUNK:] < 0).argmax()) + 1 if len(ids) > CHUNK else len(ids)
        yield ids[:end]
        ids = ids[end:]


def _as_ids(source: DataFrame, words) -> DataFrame:
    """Texts as ids, -1 where a word has none and between pieces. Rows are short, so
    that few bytes reach a task at once, and each ends with -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_lang: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(words.value):
            per_lang.setdefault(lang, {})[word] = i
        for batch in batches:
            for lang, texts in _by_lang(batch):
                find = per_lang.get(lang, {}).get
                found = [find(w, -1) for w in words_of(texts)]
                found.append(-1)
                ids = np.array(found, dtype="<i4")
                # No phrase crosses a -1, so rows may end there.
                gaps = np.flatnonzero(ids < 0) + 1
                ends = np.unique(gaps[np.searchsorted(gaps, np.arange(ROW, len(ids) + ROW, ROW).clip(max=len(ids)))])
                raw, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
                rows = [raw[a:b] for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_pydict({"ids": pa.array(rows, pa.binary())})

    return source.mapInArrow(run, "ids binary")


def _rare_bit(words: list[bytes], bits: int) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], dtype=np.int64) & ((1 << bits) - 1)


def _rare_phrases(spark: SparkSession, source: DataFrame, rare: DataFrame, words, least: int) -> DataFrame:
    """Counts of phrases of two words or more with at least one word of ``rare``
    (lang, word): frequent enough, but without an id."""
    bits = min(MOST_BITS, max(3, 8 * rare.count()).bit_length())

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            at = np.unique(_rare_bit([w.encode() for w in found], bits))
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64())})

    def pack(table: pa.Table) -> pa.Table:
        mine = np.zeros(SLICE, dtype=np.uint8)
        at = table.column("at").to_numpy()
        mine[at % SLICE] = 1
        return pa.table({"slice": pa.array([int(at[0]) // SLICE], pa.int64()), "bits": pa.array([np.packbits(mine).tobytes()], pa.binary())})

    places = rare.select("word").mapInArrow(mark, "at long").distinct()
    slices = places.groupBy(F.floor(F.col("at") / SLICE).alias("slice")).applyInArrow(pack, "slice long, bits binary")
    out = np.zeros(max(SLICE, 1 << bits) // 8, dtype=np.uint8)
    for row in slices.collect():  # as large as the bits, 16 MB at most
        out[row["slice"] * SLICE // 8 :][: SLICE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    marks = spark.sparkContext.broadcast(out.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[bytes]] = {}
        for lang, word in words.value:
            known.setdefault(lang, set()).add(word)
        occupied = np.frombuffer(marks.value, dtype=np.uint8)
        for batch in batches:
            for lang, texts in _by_lang(batch):
                mine, found = known.get(lang, set()), words_of(texts)
                rare_here = _marked(occupied, _rare_bit(found, bits)) if found else np.zeros(0, bool)
                # 0: cannot be in a frequent phrase, 1: has an id, 2: may be of the rare.
                kind = [0 if w == b"\xff" else 1 if w in mine else 2 * int(r) for w, r in zip(found, rare_here)]
                counts: Counter = Counter()
                for i in range(len(found)):
                    upto = i
                    while upto < len(found) and upto - i < LONGEST and kind[upto]:
                        upto += 1
                    for end in range(i + 2, upto + 1):
                        if 2 in kind[i:end]:
                            counts[b" ".join(found[i:end])] += 1
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(counts), pa.string()),
                    "phrase": pa.array(list(counts), pa.binary()).cast(pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                })

    counted = source.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase")
    return counted.agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def frequent_phrases(source: DataFrame, words: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS) -> DataFrame:
    """``lang, phrase, size, n`` of all phrases of one to four words that occur
    ``least`` times or more; ``words`` are the counts of words, stored."""
    spark = source.sparkSession
    ship_package(spark)
    often = words.where(F.col("n") >= least)
    total = often.agg(F.sum("n")).first()[0] or 0
    has_id = frequent(often, "n", most_words)
    rows = often.where(has_id).orderBy(F.desc("n"), "lang", "word").select("lang", "word").collect()
    names = spark.sparkContext.broadcast([(r["lang"], r["word"].encode()) for r in rows])
    out = often.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")
    if rows:
        tokens = stored(_as_ids(source, names), "phrase-ids")
        shorter, bits = None, None
        for size in range(2, LONGEST + 1):
            layout = Layout(size, len(rows), total, least)
            counted = count_phrases(tokens, layout, shorter, bits, names, least)
            out = out.unionByName(counted.where("shard is null").select("lang", "phrase", "size", "n"))
            if size < LONGEST:
                shorter, bits = layout, _bits(spark, counted, layout)
    rare = often.where(~has_id)
    if not rare.isEmpty():
        late = _rare_phrases(spark, source, rare, names, least)
        size = (F.regexp_count("phrase", F.lit(" ")) + 1).cast("int")
        out = out.unionByName(late.withColumn("size", size).select("lang", "phrase", "size", "n"))
    return out


# --- collocations --------------------------------------------------------


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    top: int = TOP,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """The first ``top`` of each language: lang, rank, phrase, a (occurrences), l and
    r (those of the two parts at the weakest cut), n (words of the language), score.

    A phrase's score is that of its lowest cut; phrases that a longer one holds nearly
    always are left out."""
    source = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")
    )
    ship_package(docs.sparkSession)
    words = stored(word_counts(source), "phrase-words")
    # One row per language; a broadcast of them is as small.
    sizes = words.groupBy("lang").agg(F.sum("n").alias("total"))
    counted = stored(frequent_phrases(source, words, least, most_words), "phrase-counts")

    phrases = counted.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = stored(
        phrases.select(
            "lang", "phrase", F.col("n").alias("a"), "size",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.col("size") - 1),
                    lambda k: F.struct(
                        k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("left"),
                        F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("right"),
                    ),
                )
            ).alias("_", "cut"),
        ).select("lang", "phrase", "a", "size", "cut.*"),
        "phrase-cuts",
    )
    # A part starts or ends at most as many phrases as it occurs, so few parts are hot.
    parts = counted.select("lang", "phrase", "n", F.col("n").alias("times"))
    left = met(cuts, parts.withColumnsRenamed({"phrase": "left", "times": "l"}), ["lang", "left"], "n")
    both = met(
        stored(left, "phrase-left"), parts.withColumnsRenamed({"phrase": "right", "times": "r"}), ["lang", "right"], "n"
    )
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    exact = F.expr(f"cast(a as decimal(30,0)) * cast({SCALE} as decimal(7,0)) div (l + r)").cast("long")
    weakest = (
        both.withColumn("score", exact)
        .groupBy("lang", "phrase", "a", "size")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
        .select("lang", "phrase", "a", "size", "c.score", "c.l", "c.r")
    )
    longer = phrases.where("size > 2").select(
        "lang", F.col("n").alias("around"),
        F.explode(
            F.filter(
                F.flatten(F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda w: F.transform(
                        F.sequence(F.lit(1), F.col("size") - w + 1),
                        lambda at: F.array_join(F.slice("words", at, w), " "),
                    ),
                )),
                lambda p: p.isNotNull(),
            )
        ).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    contained = F.coalesce(whole("around"), F.lit(0)) * 100 >= whole("a") * CONTAINED
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(~contained)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = Window.partitionBy("lang", "_salt").orderBy(*order)
    best = (
        kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .where(F.col("rank") <= top)
    )
    return best.join(F.broadcast(sizes), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
