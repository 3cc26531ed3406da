"""Small frames with the awkward rows that every operator must take."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, size int"
WORDS = "the of and in to river stone cloud maple winter candle bridge garden silver thunder meadow".split()


def prose(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", str(rng.randint(0, 99))]) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and long texts, ties, repeated rows,
    accents and emoji; columns whose names operators use inside."""
    base = prose(1)
    texts = {
        0: base, 1: base, 2: base + " more", 3: None, 4: "", 5: " \t\n ", 6: "one", 7: "one two three",
        8: "Ünïcode 🙂 text " * 12, 9: prose(9, 20_000), 10: "x" * 5000, 11: base.upper(),
        12: "line of words here\n" * 30, 13: "## $$ %% && | < > " * 10, 14: "a b c \x1c d",
    }
    rows = [
        (i, t, "en" if i % 3 else None, "src" if i % 4 else None, len(t or ""), "r", 0.5, i)
        for i, t in texts.items()
    ]
    rows += [rows[0], rows[0], (None, None, None, None, None, None, None, None), (None, base, "en", "src", 3, None, None, 1)]
    return rows


def frame(spark, rows, schema=COLUMNS):
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    return frame(spark, awkward_rows()).repartition(3)


def empty(spark):
    return frame(spark, [])


def labels(spark, name, rows=()):
    return spark.createDataFrame(list(rows), f"doc_id long, {name} int")
