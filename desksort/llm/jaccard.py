"""Exact Jaccard self-join of shingle sets, as components of linked documents.

A text's set holds its distinct runs of five words; two texts link when 100 times
the intersection is 75 times the union or more. Method: set relations skip work.

* Equal sets are one set from the start; copies are never compared.
* Shingles are ordered by how often they occur (counts in a table of fixed size,
  then the shingle's hash). Linked sets share a shingle among the first quarter
  of both, so only those are indexed, and frequent ones come last.
* An index list is kept in blocks by set size, entries carry their position: a
  block of another size is skipped whole, and an entry so far back that the rest
  could not reach the threshold is skipped by its position.
* Short lists give their pairs. In long lists, sets are first compared with a few
  pivots of their list. What a set's answers have placed in a component need not
  be compared inside it: from there on only sets that lie outside their list's
  main component are compared with the rest of the list, all of it. So a group
  of near copies costs a few comparisons per copy, and no link between
  components is lost.
* Of the pairs that are left, parities of the sets rule out those that differ in too
  many shingles: first 512 bits that entries of long lists carry into the join, then
  a bit or two per shingle. The others are decided on both whole sets.

Hashes have 64 bits; sets count as equal when their hash and size are. A list
that the counts show to be very long is dealt out in several parts; the pivots
are those of the whole list.

Defined cases: null texts and texts without words have an empty set and link with
nothing; fewer than five words are one shingle; repeated rows are copies; a
component takes its smallest id, null where it has none; rows with an empty set
take their own id; no rows give no rows. Extra columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import FEW_IDS, only, stored
from .components import components

WORDS = 5
PERCENT = 75
BINS = 18  # bits of the table of counts
CHUNK = 14  # bits of it that travel together
SHORT = 32  # entries of a list whose pairs are given at once
PART = 100_000  # entries of a list from which it is dealt out in parts
SEEDS = (1, 2, 3)  # of the rounds of pivots
PIVOTS = 3  # that a set is compared with in a round
PARTNER_SEEDS = (11, 12, 13)  # of the rounds of partners
PARTNERS = 8  # that a set is compared with in such a round
REMEMBERED = 100_000  # word hashes that a worker keeps
DEALT = 16  # lists that a set's partners are dealt out in
TOGETHER = 500  # texts whose index entries or sets are sent together
SKETCH = 8  # longs of a set's parities that its entries in long lists carry


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hash_of = _WordHashes()
_FACTORS = np.array(
    [xxhash.xxh3_64_intdigest(f"place {i}") | 1 for i in range(WORDS)], dtype=np.uint64
)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = (text or "").encode().lower().split()
    k = min(WORDS, len(words))
    if not k:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(_hash_of.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(words) - k + 1
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total += each[i : i + n] * _FACTORS[i]
    # Sums of products are spread evenly before their high bits are used.
    total ^= total >> np.uint64(32)
    total *= np.uint64(xxhash.xxh3_64_intdigest("spread") | 1)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def set_name(found: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.array([xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found))], dtype=np.uint64).view(np.int64)[0])


def parities(found: np.ndarray) -> bytes:
    """Whether an even or odd number of the set's hashes falls to each place, of
    twice as many places as hashes or more, a power of two."""
    places = 1 << max(6, int(2 * len(found) - 1).bit_length())
    at = (found & np.uint64(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places).astype(np.uint8) & 1, bitorder="little").tobytes()


def sketch(found: np.ndarray) -> list[int]:
    """The set's parities over a fixed number of places, 64 in each of ``SKETCH`` longs."""
    places = 64 * SKETCH
    at = (found & np.uint64(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places).astype(np.uint8) & 1, bitorder="little").view(np.int64).tolist()


def least_difference(x: bytes, y: bytes) -> int:
    """Hashes in one set only: at least as many as there are places with
    different parities. More places are folded onto fewer."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    a, b, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(y)
    while size > len(x):
        size //= 2
        b = (b >> (8 * size)) ^ (b & ((1 << (8 * size)) - 1))
    return (a ^ b).bit_count()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``TOGETHER`` rows, as what is made of them is larger."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)


# --- first pass: the sets' names and the counts ---------------------------

FACTS = "kind int, doc_id long, n long, name long, chunk int, part int, bins binary, counts binary"


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end this task's counts per bin."""
    table = np.zeros(1 << BINS, dtype=np.int64)
    schema = pa.schema(
        [("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("name", pa.int64()),
         ("chunk", pa.int32()), ("part", pa.int32()), ("bins", pa.binary()), ("counts", pa.binary())]
    )
    for batch in batches:
        sizes, names = [], []
        for text in batch.column(1):
            found = shingles(text.as_py())
            sizes.append(len(found))
            names.append(set_name(found) if len(found) else None)
            at, times = np.unique(found >> np.uint64(64 - BINS), return_counts=True)
            table[at.astype(np.int64)] += times
        n = batch.num_rows
        none = [None] * n
        yield pa.RecordBatch.from_pydict(
            {"kind": [0] * n, "doc_id": batch.column(0), "n": sizes, "name": names, "chunk": none,
             "part": none, "bins": none, "counts": none}, schema
        )
    part = TaskContext.get().partitionId()
    rows = []
    for chunk in range(1 << (BINS - CHUNK)):
        own = table[chunk << CHUNK : (chunk + 1) << CHUNK]
        at = np.flatnonzero(own)
        if len(at):
            rows.append((chunk, at.astype(np.uint16).tobytes(), own[at].tobytes()))
    k = len(rows)
    yield pa.RecordBatch.from_pydict(
        {"kind": [1] * k, "doc_id": [None] * k, "n": [None] * k, "name": [None] * k,
         "chunk": [r[0] for r in rows], "part": [part % 64] * k,
         "bins": [r[1] for r in rows], "counts": [r[2] for r in rows]}, schema
    )


def _table_of_counts(facts: DataFrame) -> np.ndarray:
    """The sum of all tasks' counts; its size is fixed."""
    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK, dtype=np.int64)
        for bins, counts in zip(rows["bins"], rows["counts"]):
            total[np.frombuffer(bins, dtype=np.uint16).astype(np.int64)] += np.frombuffer(counts, dtype=np.int64)
        at = np.flatnonzero(total)
        return pd.DataFrame(
            {"chunk": rows["chunk"].iloc[:1].to_numpy(), "bins": [at.astype(np.uint16).tobytes()],
             "counts": [total[at].tobytes()]}
        )

    schema = "chunk int, bins binary, counts binary"
    own = facts.where("kind = 1").select("chunk", "part", "bins", "counts")
    # 64 sums for each chunk, then one of those.
    summed = own.groupBy("chunk", "part").applyInPandas(added, schema).groupBy("chunk").applyInPandas(added, schema)
    table = np.zeros(1 << BINS, dtype=np.int64)
    for r in summed.collect():
        at = np.frombuffer(r["bins"], dtype=np.uint16).astype(np.int64) + (r["chunk"] << CHUNK)
        table[at] = np.frombuffer(r["counts"], dtype=np.int64)
    return table


# --- second pass: the index ------------------------------------------------


def _index(docs: DataFrame, table: np.ndarray, percent: int) -> DataFrame:
    """hash, dealt, name, size, pos: the entries of each set's first shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for batch in _parts(batches):
            out: list[tuple] = []
            for text in batch.column(0):
                found = shingles(text.as_py())
                n = len(found)
                name = set_name(found) if n else None
                if not n or name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                often = counts[(found >> np.uint64(64 - BINS)).astype(np.int64)]
                first = n - -(-percent * n // 100) + 1
                order = np.lexsort((found, often))[:first]
                parts = often[order] // PART
                dealt = np.where(parts > 0, name % (parts + 1), -1)
                out.append((found[order].view(np.int64), dealt, np.full(first, name), np.full(first, n, np.int32)))
            if out:
                pos = np.concatenate([np.arange(len(o[0]), dtype=np.int32) for o in out])
                cols = [np.concatenate([o[i] for o in out]) for i in range(4)]
                yield pa.RecordBatch.from_pydict(
                    {"hash": cols[0], "dealt": cols[1].astype(np.int32), "name": cols[2], "size": cols[3], "pos": pos}
                )

    return docs.mapInArrow(run, "hash long, dealt int, name long, size int, pos int")


FOUND = "hash long, a long, b long, size int, pos int"


def _lists(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Index entries sorted by list, size and name: pairs (a, b) of short lists,
    entries (a, b null) of long ones. Holds a batch and a short list at most."""
    names = ("hash", "dealt", "name", "size", "pos")
    held = None
    long_list = None  # the list that the entries before belong to, if it is long

    def out(hashes, a, b, size, pos) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_pydict(
            {"hash": hashes, "a": a, "b": none if b is None else b, "size": size.astype(np.int32), "pos": pos.astype(np.int32)}
        )

    def work(c: dict[str, np.ndarray], last: bool):
        """The finished lists' output, and the entries of the unfinished one."""
        nonlocal long_list
        n = len(c["hash"])
        same = np.zeros(n, dtype=bool)
        same[1:] = (c["hash"][1:] == c["hash"][:-1]) & (c["dealt"][1:] == c["dealt"][:-1])
        twin = same.copy()
        twin[1:] &= c["name"][1:] == c["name"][:-1]
        if twin.any():
            c, same = {k: v[~twin] for k, v in c.items()}, same[~twin]
            n = len(same)
        starts = np.flatnonzero(~same)
        sizes = np.diff(np.append(starts, n))
        key = (int(c["hash"][0]), int(c["dealt"][0]))
        is_long = (sizes > SHORT) | (c["dealt"][starts] >= 0)
        if long_list == key:
            is_long[0] = True
        tail = None
        if not last:
            if is_long[-1]:
                long_list = (int(c["hash"][-1]), int(c["dealt"][-1]))
            else:
                tail = {k: v[starts[-1] :] for k, v in c.items()}
                long_list = None
                n, sizes, is_long = int(starts[-1]), sizes[:-1], is_long[:-1]
                c = {k: v[:n] for k, v in c.items()}
                starts = starts[:-1]
        rows = []
        in_long = np.repeat(is_long, sizes)
        at = np.flatnonzero(in_long)
        if len(at):
            rows.append(out(c["hash"][at], c["name"][at], None, c["size"][at], c["pos"][at]))
        group = np.repeat(np.arange(len(sizes)), sizes)
        size, pos = c["size"].astype(np.int64), c["pos"].astype(np.int64)
        for step in range(1, min(SHORT, n)):
            i = np.flatnonzero((group[step:] == group[:-step]) & ~in_long[step:])
            if not len(i):
                break
            j = i + step
            # Sizes rise in a list; rest: shingles from here on.
            rest = np.minimum(size[i] - pos[i], size[j] - pos[j])
            ok = (100 * size[i] >= percent * size[j]) & ((100 + percent) * rest >= percent * (size[i] + size[j]))
            i, j = i[ok], j[ok]
            if len(i):
                low, high = np.minimum(c["name"][i], c["name"][j]), np.maximum(c["name"][i], c["name"][j])
                rows.append(out(c["hash"][i], low, high, size[i], pos[i]))
        return rows, tail

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {k: batch.column(i).to_numpy() for i, k in enumerate(names)}
        if held is not None:
            columns = {k: np.concatenate([held[k], columns[k]]) for k in names}
        rows, held = work(columns, False)
        yield from rows
    if held is not None:
        yield from work(held, True)[0]


# --- comparing ---------------------------------------------------------------


def _needed_sets(docs: DataFrame, sets: DataFrame, names: DataFrame) -> DataFrame:
    """name, size, bits, sketch and members (sorted hashes as bytes) of the named
    sets, out of one text each."""
    ids = stored(names.join(sets, "name").select("key").distinct(), "jaccard-keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = [f for f in (shingles(t.as_py()) for t in batch.column(0)) if len(f)]
            yield pa.RecordBatch.from_pydict(
                {"name": pa.array([set_name(f) for f in found], pa.int64()),
                 "size": pa.array([len(f) for f in found], pa.int64()),
                 "bits": pa.array([parities(f) for f in found], pa.binary()),
                 "sketch": pa.array([sketch(f) for f in found], pa.list_(pa.int64())),
                 "members": pa.array([f.tobytes() for f in found], pa.binary())}
            )

    texts = only(docs.select("key", "text"), ids, "key").select("text")
    members = texts.mapInArrow(run, "name long, size long, bits binary, sketch array<long>, members binary")
    # Only where ids repeat is there more than one text of a key.
    once = only(docs.select("key"), ids, "key").count() <= ids.count()
    return members if once else members.dropDuplicates(["name"])


def _links(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, decided on both whole sets. What the parities,
    a fraction of a set's size, rule out is not compared; sets that no pair names
    stay where they are."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            kept = [
                i for i in range(batch.num_rows)
                if (100 + percent) * (n[i] + m[i] - least_difference(x[i], y[i])) >= 2 * percent * (n[i] + m[i])
            ]
            yield batch.select([0, 1]).take(pa.array(kept, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * common >= percent * (len(both) - common):
                    kept.append(i)
            yield pa.RecordBatch.from_pydict(
                {"a": batch.column(0).take(pa.array(kept, pa.int32())), "b": batch.column(1).take(pa.array(kept, pa.int32()))}
            )

    def beside(some: DataFrame, *wanted: str) -> DataFrame:
        """Pairs, which should be stored, with what is wanted of both sets. A set meets
        its partners in ``DEALT`` lists, so it is looked up once for each, not for each
        pair, and no list holds all partners of a set with many."""

        def own(c: str) -> DataFrame:
            needed = some.select(F.col(c).alias("name")).distinct()
            return only(members, needed, "name").select(
                F.col("name").alias(c), *[F.col(w).alias(f"{w}_{c}") for w in wanted]
            )

        dealt = some.groupBy("b", F.pmod(F.xxhash64("a"), F.lit(DEALT)).alias("part"))
        lists = dealt.agg(F.collect_list("a").alias("partners")).drop("part").join(own("b"), "b")
        each = lists.withColumn("a", F.explode("partners")).drop("partners").join(own("a"), "a")
        return each.select("a", "b", *[f"{w}_{c}" for w in wanted for c in ("a", "b")])

    near = stored(beside(pairs, "size", "bits").mapInArrow(possible, "a long, b long"), "jaccard-possible")
    return beside(near, "members").mapInArrow(run, "a long, b long")


def _may_link(n: Column, p: Column, m: Column, q: Column, percent: int) -> Column:
    """By sizes, and by what is left of both sets from their positions on."""
    rest = F.least(n - p, m - q)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * rest >= percent * (n + m))


def _sketches_may_link(n: Column, x: Column, m: Column, y: Column, percent: int) -> Column:
    """By the sketches of both sets: they differ in as many hashes at least as in places."""
    apart = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    return (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _lowest(pairs: DataFrame, rank: Column, most: int) -> DataFrame:
    """Of each b's pairs (a, b), those that rank lowest."""
    ranked = F.array_sort(F.collect_set(F.struct(rank.alias("rank"), "a")))
    chosen = pairs.groupBy("b").agg(F.slice(ranked, 1, most).alias("chosen"))
    return chosen.select("b", F.explode("chosen.a").alias("a")).select("a", "b")


def _placed(entries: DataFrame, placed: DataFrame | None) -> DataFrame:
    """Entries with the component of their set: itself until it is placed."""
    if placed is None:
        return entries.withColumn("component", F.col("name"))
    return entries.join(placed.withColumnRenamed("vertex", "name"), "name", "left").withColumn(
        "component", F.coalesce("component", "name")
    )


def _pivot_pairs(entries: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs of a long list's pivot (a) and an entry of another component (b): a
    few for each entry over all its lists.

    Frequent shingles stand last in a set, so a set in which the list's shingle
    stands far in front has few of its own: it is close to what the list's sets
    have in common, and links with more of them than others do. Of the sets in
    the front sixteenth the one whose name hashes lowest is the pivot.
    """
    far = F.floor(16 * F.col("pos") / F.col("size"))
    pivot = F.min(
        F.struct(far.alias("far"), F.xxhash64("name", F.lit(seed)).alias("h"), "name", "size", "pos", "component")
    )
    pivots = entries.groupBy("hash").agg(pivot.alias("p"))
    pairs = entries.join(pivots, "hash").where(
        (F.col("p.component") != F.col("component"))
        & _may_link(F.col("size"), F.col("pos"), F.col("p.size"), F.col("p.pos"), percent)
    )
    found = pairs.select(F.col("p.name").alias("a"), F.col("name").alias("b"), "p.far", "p.h")
    return _lowest(found, F.struct("far", "h"), PIVOTS)


def _banded(known: DataFrame, percent: int) -> DataFrame:
    """Entries with their size block: sets that may link are in blocks side by side."""
    wide = math.log(105 / percent)  # a little more than sizes of linked sets differ
    return known.withColumn("band", F.floor(F.log("size") / F.lit(wide)).cast("int"))


def _outside(known: DataFrame) -> DataFrame:
    """Entries of sets outside their list's largest component, as o_name and so on,
    for each block that may hold sets they link with."""
    shares = known.groupBy("hash", "component").agg(F.count("*").alias("n"))
    main = shares.groupBy("hash").agg(
        F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("components")
    ).where("components > 1")
    return known.join(main, "hash").where(F.col("component") != F.col("main.component")).select(
        "hash", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
        *[F.col(c).alias(f"o_{c}") for c in ("name", "size", "pos", "component", "sketch")],
    )


def _met_outside(some: DataFrame, outside: DataFrame, percent: int) -> DataFrame:
    """Entries beside those outside of another component in their list and block. The
    join itself leaves out what sizes, positions and sketches rule out: in a group of
    near copies that is most of what lies outside its main component."""
    return some.join(outside, ["hash", "band"]).where(
        (F.col("component") != F.col("o_component"))
        & _may_link(F.col("size"), F.col("pos"), F.col("o_size"), F.col("o_pos"), percent)
        & _sketches_may_link(F.col("size"), F.col("sketch"), F.col("o_size"), F.col("o_sketch"), percent)
    )


def _partner_pairs(known: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs of a set outside its lists' largest components (b) and a few of other
    components (a): of each block of a list ``PARTNERS`` are drawn, those in front
    before others, and a set tries those of two of its lists."""
    known = _banded(known, percent)
    h = F.xxhash64("name", F.lit(seed))
    far = F.floor(8 * F.col("pos") / F.col("size"))
    drawn = known.groupBy("hash", "band", F.pmod(h, F.lit(PARTNERS)).alias("draw")).agg(
        F.min(F.struct(far.alias("far"), h.alias("h"), "name", "size", "pos", "component", "sketch")).alias("p")
    ).select("hash", "band", "p.*")
    outside = _outside(known)
    # Where the list's shingle is in front, more sets can reach the threshold.
    back = F.floor(16 * F.col("o_pos") / F.col("o_size"))
    turn = F.struct(back.alias("back"), F.xxhash64("hash", "o_name", F.lit(seed)).alias("h"))
    lists = _lowest(outside.select(F.col("hash").alias("a"), F.col("o_name").alias("b"), turn.alias("turn")), F.col("turn"), 2)
    lists = lists.select(F.col("a").alias("hash"), F.col("b").alias("o_name"))
    found = _met_outside(drawn, outside.join(lists, ["o_name", "hash"]), percent)
    return _lowest(
        found.select(F.col("name").alias("a"), F.col("o_name").alias("b"), "far", "h"), F.struct("far", "h"), PARTNERS
    )


def _outside_pairs(known: DataFrame, percent: int) -> DataFrame:
    """What pivots and partners leave open in long lists: sets outside the list's
    largest component (b), with all sets of another component in their list (a) whose
    size block is theirs or next to it."""
    known = _banded(known, percent)
    pairs = _met_outside(known, _outside(known), percent)
    return pairs.select(F.col("name").alias("a"), F.col("o_name").alias("b"))


def _merged(placed: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components with more links: what is placed together already is one vertex, so
    only new links are followed."""
    if placed is None:
        return components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    new = ends.join(placed, "vertex", "left_anti").select("vertex", F.col("vertex").alias("component"))
    known = stored(placed.unionByName(new), "jaccard-known")
    of = only(known, ends, "vertex")
    for c in ("a", "b"):
        links = links.join(of.select(F.col("vertex").alias(c), F.col("component").alias(f"of_{c}")), c)
    moved = components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    moved = moved.select(F.col("vertex").alias("component"), F.col("component").alias("to"))
    return stored(
        known.join(moved, "component", "left").select("vertex", F.coalesce("to", "component").alias("component")),
        "jaccard-components",
    )


def _set_components(docs: DataFrame, sets: DataFrame, table: np.ndarray, percent: int) -> DataFrame:
    """vertex (a set's name), component, for sets that link with another set."""
    index = _index(docs.select("text"), table, percent)
    found = stored(
        index.repartition("hash", "dealt")
        .sortWithinPartitions("hash", "dealt", "size", "name")
        .mapInArrow(lambda batches: _lists(batches, percent), FOUND),
        "jaccard-found",
    )
    pairs = stored(found.where(F.col("b").isNotNull()).select("a", "b").distinct(), "jaccard-pairs")
    entries = stored(
        found.where(F.col("b").isNull()).select("hash", F.col("a").alias("name"), "size", "pos"), "jaccard-entries"
    )
    names = pairs.select(F.explode(F.array("a", "b")).alias("name")).union(entries.select("name")).distinct()
    members = stored(_needed_sets(docs, sets, names), "jaccard-members")
    entries = stored(entries.join(members.select("name", "sketch"), "name"), "jaccard-sketched")
    # First answers: for each set of a short list one neighbour; in long lists,
    # round by round, pivots for what is not in their component yet.
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links, placed = _lowest(both, F.xxhash64("a"), 1), None
    links = stored(_links(stored(links, "jaccard-first"), members, percent), "jaccard-links")
    for seed in SEEDS:
        tried = stored(_pivot_pairs(_placed(entries, placed), seed, percent), "jaccard-pivots")
        if not tried.isEmpty():
            links = links.union(stored(_links(tried, members, percent), "jaccard-links"))
        elif placed is not None:
            break
        placed = _merged(placed, links)
        links = links.limit(0)
    # Sets that no pivot has placed try a few others of their lists.
    for seed in PARTNER_SEEDS:
        tried = stored(_partner_pairs(stored(_placed(entries, placed), "jaccard-placed"), seed, percent), "jaccard-partners")
        found = stored(_links(tried, members, percent), "jaccard-links")
        if found.isEmpty():
            break
        placed = _merged(placed, found)
    # Then all that lies between the components that these give.
    of = lambda c: placed.select(F.col("vertex").alias(c), F.col("component").alias(f"of_{c}"))
    between = (
        pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    )
    known = stored(_placed(entries, placed), "jaccard-placed")
    rest = stored(between.union(_outside_pairs(known, percent)).distinct(), "jaccard-rest")
    more = stored(_links(rest, members, percent), "jaccard-links")
    return placed if more.isEmpty() else _merged(placed, more)


def _grouped(source: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, name, component (null without shingles) of rows of doc_id, text."""
    ship_package(source.sparkSession)
    facts = stored(source.mapInArrow(_facts, FACTS), "jaccard-facts")
    rows = facts.where("kind = 0").select("doc_id", "n", "name")
    lowest = F.coalesce("doc_id", F.lit(-(2**63)))
    # One text of each set: the key finds it again, null ids share one.
    sets = stored(
        rows.where("n > 0").groupBy("name").agg(F.min(lowest).alias("key")), "jaccard-sets"
    )
    placed = _set_components(source.withColumn("key", lowest), sets, _table_of_counts(facts), percent)
    return rows.join(placed.withColumnRenamed("vertex", "name"), "name", "left").select(
        "doc_id", "n", "name", F.coalesce("component", "name").alias("component")
    )


def linked_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(_grouped(source, percent), "jaccard-grouped")
    least = rows.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` of each component: that with the smallest id, null ids
    last, then the smallest set name; of rows alike in both, that with the smallest
    hash. Rows with an empty set all stay. Rows are not shuffled while the list of
    those to drop is small enough to be sent to every task."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(_grouped(source, percent).where("n > 0"), "jaccard-grouped")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "name")
    best = rows.groupBy("component").agg(F.min(rank).alias("best"))
    judged = rows.join(best, "component").withColumn("stays", rank == F.col("best"))
    counted = stored(judged.groupBy("doc_id", "name", "stays").count(), "jaccard-judged")
    gone = counted.where("NOT stays").select("doc_id", "name")
    again = counted.where("stays AND count > 1").select("doc_id", "name")

    @F.pandas_udf("long")
    def name_of(texts: pd.Series) -> pd.Series:
        found = (shingles(t) for t in texts)
        return pd.Series([set_name(f) if len(f) else None for f in found], dtype="Int64")

    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"), name_of.asNondeterministic()(F.col(text)).alias("name"),
    )

    def same(other: str) -> Column:
        return (F.col("k.name") == F.col(f"{other}.name")) & F.col("k.doc_id").eqNullSafe(F.col(f"{other}.doc_id"))

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= FEW_IDS else df

    kept = packed.alias("k").join(sent(gone).alias("g"), same("g"), "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    marked = kept.join(sent(again.withColumn("repeats", F.lit(True))).alias("a"), same("a"), "left").select(
        "k.*", "a.repeats"
    )
    one = marked.where("repeats").groupBy("doc_id", "name").agg(
        F.min_by("row", F.struct(F.xxhash64(F.to_json("row")), F.to_json("row"))).alias("row")
    )
    return marked.where("repeats IS NULL").select("row").union(one.select("row")).select("row.*")
