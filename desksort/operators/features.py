"""Word and word-pair TF-IDF features."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_ascii, lower_case


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """``translate`` arguments that strip accents: letters whose compatibility
    form is one plain character map to it, combining marks map to nothing."""
    plain, marks = {}, []
    for code in range(0x80, 0x110000):
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        base = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
        if not base:  # a mark that comes apart into marks
            marks.append(char)
        elif len(base) == 1 and base[0] != char:
            plain[char] = base[0]
    return "".join([*plain, *marks]), "".join(plain.values())


@lru_cache(maxsize=1)
def _long_forms() -> dict[str, str]:
    """Characters that come apart into several: ligatures, fractions, squared and
    circled signs, syllables. Their forms follow from the standard, none is listed."""
    out = {}
    for code in range(0x80, 0x110000):
        form = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in form if not unicodedata.combining(c))
        if len(base) > 1:
            out[chr(code)] = base
    return out


# Korean syllables come apart by rule: 19 leads, 21 vowels and no or one of 27 tails.
HANGUL, LEADS, VOWELS, TAILS = 0xAC00, 19, 21, 28


def _is_hangul(code: int) -> bool:
    return HANGUL <= code < HANGUL + LEADS * VOWELS * TAILS


def _letters_of(at: Column) -> Column:
    """The letters of the Korean syllable at this place of their block."""
    lead, vowel, tail = (
        F.array(*[F.lit(c) for c in part])
        for part in (
            [chr(0x1100 + i) for i in range(LEADS)], [chr(0x1161 + i) for i in range(VOWELS)],
            ["", *(chr(0x11A7 + i) for i in range(1, TAILS))],
        )
    )
    block = VOWELS * TAILS
    return F.concat(
        F.get(lead, F.floor(at / block).cast("int")),
        F.get(vowel, F.floor(at % block / TAILS).cast("int")),
        F.get(tail, (at % TAILS).cast("int")),
    )


@lru_cache(maxsize=1)
def _long_class() -> str:
    """A pattern for any character with a long form, or a Korean syllable."""
    codes = sorted(map(ord, _long_forms()))
    starts = [x for x, before in zip(codes, [-1, *codes]) if before != x - 1]
    ends = [x for x, after in zip(codes, [*codes[1:], -1]) if after != x + 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def _apart(c: Column) -> Column:
    """Each character by its long form, if it has one, inside the row. Only texts
    that hold such a character are taken apart."""
    forms = {k: v for k, v in _long_forms().items() if not _is_hangul(ord(k))}
    pairs = "\x01".join(f"{k}\x02{v}" for k, v in forms.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))

    def one(letter: Column) -> Column:
        code = F.ascii(letter)
        syllable = code.between(HANGUL, HANGUL + LEADS * VOWELS * TAILS - 1)
        return (
            F.when(code < 0x80, letter)
            .when(syllable, _letters_of(code - HANGUL))
            .otherwise(F.coalesce(F.element_at(table, letter), letter))
        )

    # The class has hundreds of ranges, so only what is not ASCII is held against it.
    others = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return F.when(others.rlike(_long_class()), F.array_join(F.transform(F.split(c, ""), one), "")).otherwise(c)


def strip_accents(c: Column) -> Column:
    """The text's compatibility form without accents. Characters with longer forms
    come apart first, as what they become is plain."""
    source, target = _accent_table()
    stripped = F.translate(_apart(c), source, target)
    # Most text is plain ASCII and needs none of this.
    return F.when(is_ascii(c), c).otherwise(stripped)


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


# Two or more letters, digits or underscores of any script.
WORD = r"[\p{L}\p{N}_]{2,}"


def _analyzed(stop_words: Sequence[str]) -> list[str]:
    """Stop words cut as texts are: "isn't" stops "isn", its only word here."""
    plain = "".join(
        c for c in unicodedata.normalize("NFKD", "\n".join(stop_words).lower())
        if not unicodedata.combining(c)
    )
    return sorted(set(re.findall(r"\w{2,}", plain)))


def words(c: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Lower-case, accent-free words of two or more characters, in order,
    without stop words."""
    found = F.regexp_extract_all(strip_accents(lower_case(c)), F.lit(WORD), F.lit(0))
    stop = _analyzed(default_stop_words() if stop_words is None else stop_words)
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def with_pairs(tokens: Column) -> Column:
    """The words, then each word with the one after it."""
    pairs = F.when(
        F.size(tokens) > 1,
        F.zip_with(
            F.slice(tokens, 1, F.size(tokens) - 1),
            F.slice(tokens, 2, F.size(tokens) - 1),
            lambda a, b: F.concat(a, F.lit(" "), b),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, pairs)


def with_terms(
    df: DataFrame,
    text: str = "text_clean",
    out: str = "terms",
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Add the words and word pairs of ``text``."""
    # Two steps, so that the words are found once and named five times.
    return (
        df.withColumn("_words", words(F.col(text), stop_words))
        .withColumn(out, with_pairs(F.col("_words")))
        .drop("_words")
    )


def with_term_counts(df: DataFrame, terms: str = "terms", out: str = "term_counts") -> DataFrame:
    """Add ``array<struct<term, tf>>``, counted inside the row: the terms are
    sorted and each run of equals is measured. No shuffle."""
    return (
        df.withColumn("_sorted", F.sort_array(terms))
        .withColumn(
            "_starts",
            F.filter(
                F.transform(
                    "_sorted",
                    lambda t, i: F.when(
                        (i == 0) | (t != F.get("_sorted", i - 1)), i
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        .withColumn(
            out,
            F.transform(
                "_starts",
                lambda start, i: F.struct(
                    F.get("_sorted", start).alias("term"),
                    (F.coalesce(F.get("_starts", i + 1), F.size("_sorted")) - start).alias("tf"),
                ),
            ),
        )
        .drop("_sorted", "_starts")
    )


def _each_count() -> Column:
    # The outer form, because for the inner one Catalyst adds a filter on the
    # array's size below the counting, and so counts everything twice.
    return F.explode_outer("_counts").alias("c")


def build_vocabulary(
    df: DataFrame,
    terms: str = "terms",
    max_features: int = 10_000,
    min_df: int = 2,
    max_df: float = 0.95,
) -> DataFrame:
    """``(index, term, tf, df, idf)``: terms in at least ``min_df`` documents
    and at most a ``max_df`` share of them, the most frequent ``max_features``
    kept (ties by term), numbered in term order.

    Terms are counted inside each document first, then combined on the map
    side, so a term in every document shuffles one row per task.
    """
    docs = df.agg(F.count("*")).scalar()
    counted = with_term_counts(df.select(terms), terms, "_counts")
    stats = (
        counted.select(_each_count())
        .where(F.col("c").isNotNull())
        .groupBy(F.col("c.term").alias("term"))
        .agg(F.sum("c.tf").alias("tf"), F.count("*").alias("df"))
    )
    kept = (
        stats.withColumn("_docs", docs)
        .where((F.col("df") >= min_df) & (F.col("df") <= F.col("_docs") * F.lit(float(max_df))))
        .orderBy(F.desc("tf"), F.asc("term"))
        .limit(max_features)
    )
    # The kept terms are at most max_features rows; one task numbers them.
    return kept.select(
        (F.row_number().over(Window.orderBy("term")) - 1).alias("index"),
        "term",
        "tf",
        "df",
        (F.log((F.col("_docs") + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def tfidf_long(df: DataFrame, vocabulary: DataFrame, row_id: str, terms: str = "terms") -> DataFrame:
    """``(row_id, term, weight)`` with unit length per row. Rows are vectors of
    unit length before they are taken apart, so nothing is shuffled. The
    vocabulary, at most ``max_features`` rows, comes to the driver."""
    names = vocabulary.orderBy("index").select("index", "term")
    vectors = df.select(row_id, terms)
    for stage in vectorizer_stages(vocabulary, terms, "_vector"):
        vectors = stage.transform(vectors)
    cells = vectors.select(row_id, F.unwrap_udt("_vector").alias("_v")).select(
        row_id,
        F.inline(
            F.arrays_zip(F.col("_v.indices").alias("index"), F.col("_v.values").alias("weight"))
        ),
    )
    return cells.join(F.broadcast(names), "index").select(row_id, "term", "weight")


def vectorizer_stages(vocabulary: DataFrame, terms: str = "terms", out: str = "features") -> list:
    """Fitted ML stages from terms to unit TF-IDF vectors. The vocabulary, at
    most ``max_features`` rows, comes to the driver to become a model."""
    rows = vocabulary.select("term", "idf").orderBy("index").collect()
    if not rows:
        raise ValueError("the vocabulary is empty")
    counter = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in rows], inputCol=terms, outputCol="_counts"
    )
    scaler = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_counts", outputCol="_scaled"
    )
    return [counter, scaler, Normalizer(p=2.0, inputCol="_scaled", outputCol=out)]
