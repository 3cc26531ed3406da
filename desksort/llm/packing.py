"""Pack tokenised documents into sequences of a fixed length, by sums of squares.

A document's ids and one closing id are cut into pieces only where they are longer
than a sequence. Pieces are dealt into cells of about ``per_cell``. A cell is packed
from the longest piece down: each goes into the open sequence after which the sum,
over all gaps, of the squared number of open sequences with that gap is smallest
(ties: the fuller one); only a piece that fits nowhere opens a sequence. A cell ends
with a sequence or two that are not full, so ``per_cell`` bounds what is lost.

Pieces are dealt by their place in the stored table, not by a key: a document, an id
or a text that holds a third of all rows is spread over all cells like any other.

Ids are the tokenizer library's. Texts are cut at ASCII white space first, which no
token of the tokenizer crosses, and a worker remembers the ids of words it has met.
The tokenizer file is a parameter and is read on the driver only.

Defined cases: null and empty texts are the closing id alone; rows that repeat are
packed each; a null doc_id stays null; documents of any length are cut whole; no
rows give no rows. Only the named columns are read, so extra columns may have any
names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stored

LENGTH = 2048
PER_CELL = 16_384
TOGETHER = 20_000  # new words that are encoded as one text
WORDS_KEPT = 800_000  # words whose ids a worker remembers
GROUP = 4_000_000  # bytes of text that are looked up together


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# The tokenizer always cuts between a letter and such a character.
_end_of_word = re.compile(rb"[.,;:!?](?<=[A-Za-z].)")


def cut_words(text: str) -> list[bytes]:
    """The text in parts that the tokenizer reads apart from each other.

    Its capitals are made small here where that changes no id, so that more parts are
    equal: not beside what may be an added token, which has its own case, nor before
    accents (U+0300 to U+033F), which compose with some small letters only."""
    raw = text.encode()
    if b"<|" not in raw and b"\xcc" not in raw:
        raw = raw.translate(LOWER)
    return _end_of_word.sub(rb" \g<0>", raw).split()


class WordCodec:
    """The ids of texts, as little-endian 32-bit integers one after the other."""

    def __init__(self, tokenizer: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(tokenizer)["model"].get("end_of_word_suffix") or "\0"
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.closing[[at for token, at in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [cut_words(t) for t in texts]
        wanted = set().union(*cut)
        missing = wanted.difference(self.known)
        if len(self.known) + len(missing) > WORDS_KEPT:
            self.known = {w: self.known[w] for w in wanted - missing}
        plain, others = [], []
        for word in missing:
            (plain if word.decode().isalpha() else others).append(word)
        for at in range(0, len(plain), TOGETHER):
            self._learn_together(plain[at : at + TOGETHER])
        self._learn(others)
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def _learn(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.known.update((w, array("I", e.ids).tobytes()) for w, e in zip(words, found))

    def _learn_together(self, words: list[bytes]) -> None:
        """Words of letters only, as one text: each is cut off by one closing token."""
        text = b" ".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
        if len(ends) != len(words):  # letters that the tokenizer does not know as such
            return self._learn(words)
        raw = ids.tobytes()
        self.known.update((w, raw[a:b]) for w, a, b in zip(words, [0, *ends], ends))


_codecs: dict[str, WordCodec] = {}


def cut_pieces(
    docs: DataFrame, tokenizer_path: str, doc_id: str, text: str, length: int, end_id: int, ids: bool
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and ``ids`` if wanted."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, "rb") as file:
        data = file.read()
    key, shared = hashlib.sha256(data).hexdigest(), spark.sparkContext.broadcast(data)
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * length

    def codec() -> WordCodec:
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = WordCodec(shared.value)
        return _codecs[key]

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        keys, texts, size = [], [], 0
        for at in range(batch.num_rows):
            keys.append(batch.column(0)[at].as_py())
            texts.append(batch.column(1)[at].as_py() or "")
            size += len(texts[-1])
            if size > GROUP:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in groups(batch):
                rows = []
                for key_, raw in zip(keys, codec().encode(texts)):
                    raw += end
                    for at in range(0, len(raw), width):
                        part = raw[at : at + width]
                        rows.append((key_, at // width, at // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows))
                out = [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns[:5])]
                if ids:
                    out.append(pa.array([np.frombuffer(p, dtype="<u4").astype(np.int32) for p in columns[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=schema_names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    schema_names = [part.split()[0] for part in schema.split(", ")]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def place(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, placed in the given order.

    ``open_at[h]`` counts the open sequences filled up to ``h``. Moving one from h to
    h + s changes the sum of squares by 2 (open_at[h + s] - open_at[h] + 1), by one
    less where it becomes full and so is open no longer.
    """
    open_at = np.zeros(capacity + 1, dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(sizes), dtype=np.int64)
    offset = np.empty(len(sizes), dtype=np.int64)
    never = np.iinfo(np.int64).max
    made = 0
    for i, size in enumerate(sizes.tolist()):
        filled = 0
        if size < capacity:
            here = open_at[1 : capacity - size + 1]
            change = 2 * (open_at[1 + size :] - here + 1)
            change[-1] -= 1
            change[here == 0] = never
            last = len(change) - 1 - int(change[::-1].argmin())
            if change[last] != never:
                filled = last + 1
        if filled:
            at = waiting[filled].pop()
            open_at[filled] -= 1
        else:
            at, made = made, made + 1
        sequence[i], offset[i] = at, filled
        if filled + size < capacity:
            open_at[filled + size] += 1
            waiting[filled + size].append(at)
    return sequence, offset


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = 0,
    per_cell: int = PER_CELL,
    ids: bool = False,
) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, and with ``ids`` the piece's ids (take a smaller
    ``per_cell`` then: a cell's rows are packed by one task)."""
    pieces = stored(cut_pieces(docs, tokenizer_path, doc_id, text, length, end_id, ids), "packing-pieces")
    cells = max(1, -(-pieces.count() // per_cell))
    dealt = pieces.withColumn(
        "cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)).cast("long")
    )

    def pack(table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_numpy()
        order = np.argsort(-sizes, kind="stable")
        sequence, offset = np.empty_like(sizes), np.empty_like(sizes)
        sequence[order], offset[order] = place(sizes[order], length)
        cell = table.column("cell").to_numpy()
        out = table.drop_columns(["cell"])
        return out.append_column("sequence_id", pa.array((cell << 32) + sequence)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    return dealt.groupBy("cell").applyInArrow(pack, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, n_pieces`` of documents packed with their ids: at most a
    sequence's length of ids meet in one row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"), F.count("*").alias("n_pieces")
    )
