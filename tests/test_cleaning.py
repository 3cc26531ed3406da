import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from desksort.functions import patterns, text
from desksort.operators.cleaning import clean_columns, clean_fields, clean_joined, cleaning_counters
from tests.conftest import plan

FLAGS = re.IGNORECASE


def redact(t, flags=FLAGS, hits=None):
    for kind, pattern, token in patterns.PERSONAL_DATA:
        if hits is not None:
            hits[kind] = hits.get(kind, 0) + len(re.findall(pattern, t, flags))
        t = re.sub(pattern, token, t, flags=flags)
    return t


def normalize(t):
    for pattern, out in [*patterns.MARKUP, *patterns.NOISE]:
        t = re.sub(pattern, out, t)
    return " ".join(t.split()).lower()


def printable(t):
    return "".join(c for c in t if c.isprintable() or c.isspace())


def clean(t, low=10, high=2000):
    t = normalize(redact(printable(t)))
    return "" if len(t) < low else t[:high]


def column_of(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4, "i")
    return [r["o"] for r in df.select("i", make(F.col("t")).alias("o")).orderBy("i").collect()]


SAMPLES = [
    "Hello! My email is john.doe@example.com and phone is 555-123-4567.",
    "My account number is ACCT 123456789.\n\nThis has    multiple    spaces\tand\r\nbreaks...",
    "call (555) 123-4567 or +1-555-123-4567 or 5551234567 now!!!",
    "ssn 123-45-6789, card 4111 1111 1111 1111, ip 10.0.0.1",
    "see https://www.example.com/a?b=1&c=2 and HTTP://X.io",
    "please identify me; ticket created; case: #abc1234; Ticket ticket ticket99",
    "invoice INV99887 inv: 1234567 user ABCD1234 uid#zzzzzzz account 123456",
    "&lt;b&gt;bold&lt;/b&gt; <i>it</i> &amp;lt; &amp;amp; &nbsp;x&quot;y&quot; &#39; &#xa;",
    "a <not closed & b > c <<d>> e <> f",
    "..... .. ... !!!! ! ?? ? ---- -- === == ____ __",
    "a|b@c.d|e x@y.zz me.you+tag@sub.dom.co.uk @@ @",
    " wide　spaces here line\u0085nel\x1cfs",
    "bell\x07 zero​width private soft­hyphen",
    "short", "exactly10c", "", "   ", "é" * 9, "é" * 10, "x" * 1999 + " y", "x" * 2001,
    "ΑΣ ΣΑΣ İstanbul ÀÉÎÕÜ ß",
]


def test_cleaner_on_samples(spark):
    assert column_of(spark, SAMPLES, text.clean) == [clean(t) for t in SAMPLES]


def test_stages_on_samples(spark):
    assert column_of(spark, SAMPLES, text.redact) == [redact(t) for t in SAMPLES]
    assert column_of(spark, SAMPLES, text.strip_non_printable) == [printable(t) for t in SAMPLES]
    assert column_of(spark, SAMPLES, text.normalize) == [normalize(t) for t in SAMPLES]
    assert column_of(spark, SAMPLES, text.collapse_whitespace) == [
        " ".join(t.split()) for t in SAMPLES
    ]


PIECES = st.sampled_from([
    "ticket", "ID", "case ", "inv", "user#", "acct ", "account: ", "123456", "555-123-4567",
    "123-45-6789", "4111", "-", ".", "10.0.0.1", "a@b.co", "@", "http", "://", "x.com", "/p?q=1",
    "<", ">", "&lt;", "&gt;", "&amp;", "&nbsp;", "&#", "39;", "&quot;", "!", "?", "=", "_", "...",
    " ", "  ", "\n", "\t", "\r\n", "word", "ABCDEF", "é", " ",
])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=200, max_size=200))
def test_cleaner_on_made_up_texts(spark, texts):
    assert column_of(spark, texts, text.clean) == [clean(t) for t in texts]


def test_digits_and_letters_of_any_script(spark):
    samples = [
        "account " + "".join(chr(0x661 + i) for i in range(7)), "&#\u0663; x", "éid ABC1234",
        "4111\u00a01111\u00a01111\u00a01111", "tic\u212aet abcdef1", "u\u017fer abcdef1",
    ]
    assert column_of(spark, samples, text.redact) == [redact(t) for t in samples]
    assert column_of(spark, samples, text.normalize) == [normalize(t) for t in samples]


def test_chosen_kinds_only(spark):
    got = column_of(spark, SAMPLES[:1], lambda c: text.redact(c, kinds=["phone"]))
    assert got == ["Hello! My email is john.doe@example.com and phone is [PHONE]."]
    with pytest.raises(ValueError, match="unknown"):
        text.redact(F.lit("x"), kinds=["passport"])


def test_cleaner_is_idempotent_without_redaction(spark):
    # A cut text may end in a space, which a second pass would trim.
    plain = [s for s in SAMPLES if "&" not in s and "." not in s and len(s) < 2000]
    twice = column_of(
        spark, plain, lambda c: text.clean(text.clean(c, redact_pii=False), redact_pii=False)
    )
    assert twice == column_of(spark, plain, lambda c: text.clean(c, redact_pii=False))


def test_null_is_empty_text(spark):
    assert column_of(spark, [None], text.clean) == [""]
    assert column_of(spark, [None], text.lower_case) == [""]


def test_counters_match_a_walk_over_the_rows(spark):
    rows = [(t, None) for t in SAMPLES] + [(None, SAMPLES[0])]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {(r["column"], r["counter"]): r["n"] for r in cleaning_counters(df, ["a", "b", "zz"]).collect()}
    for column, texts in (("a", SAMPLES), ("b", SAMPLES[:1])):
        hits = {}
        sizes = [len(normalize(redact(printable(t), hits=hits))) for t in texts]
        assert got[column, "total_processed"] == len(texts)
        assert got[column, "too_short"] == sum(n < 10 for n in sizes)
        assert got[column, "too_long"] == got[column, "truncated"] == sum(n > 2000 for n in sizes)
        assert got[column, "empty_after_cleaning"] == 0
        assert {k: got[column, f"pii_{k}"] for k in hits} == hits
        assert got[column, "pii_total"] == sum(hits.values())


def test_empty_texts_are_counted_without_a_least_length(spark):
    df = spark.createDataFrame([("   ",), ("x",), (None,)], "a string")
    got = {r["counter"]: r["n"] for r in cleaning_counters(df, ["a"], min_length=0).collect()}
    assert (got["too_short"], got["empty_after_cleaning"], got["total_processed"]) == (0, 1, 2)


def test_cleaned_columns_are_kept_and_absent_ones_skipped(spark):
    df = spark.createDataFrame([("Some Long Title", "mine")], "title string, title_clean string")
    out = clean_columns(df, ["title", "absent"])
    assert out.columns == ["title", "title_clean"]
    assert out.first()["title_clean"] == "mine"


def test_fields_and_joined_forms_differ_on_short_titles(spark):
    df = spark.createDataFrame([("Hi there", "A longer description")], "title string, description string")
    assert clean_fields(df).first()["text_clean"] == " a longer description"
    assert clean_joined(df).first()["text_clean"] == "hi there a longer description"


def test_cleaning_does_not_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("title"))
    assert "Exchange" not in plan(clean_columns(df, ["title"]))
