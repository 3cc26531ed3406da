"""A quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised
statistics of a text. Ridge regression is fitted by its normal equations, which
each partition sums up for its rows and Spark sums over partitions; what reaches
the driver is one matrix whose size is a parameter. Isotonic regression on
labelled rows that the fit did not see turns raw values into probabilities; it
reads counts per thousandth of the raw value, never rows.

Learns from rows of ``labels`` whose crc32 of the id leaves another remainder
than the held-out one. Inputs are statistics of the text alone.

Defined cases: null and empty texts have zero statistics and a score like any
other; a null label is no label; a row with several labels counts with each, a
label whose id repeats counts for each row; without labels every score is 0.5;
with labels of one class scores near that class; no rows give no rows. Extra
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import crc_of_id, only, stored
from .textstats import with_statistics

N_FEATURES = 8
BINS = 1000  # of a raw value's unit, for calibration
LOWEST, HIGHEST = -1.0, 2.0  # raw values beyond are taken as these


def features(s: str = "stats") -> Column:
    words = F.greatest(F.col(f"{s}.words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(f"{s}.lines"), F.lit(1)).cast("double")
    return F.array(
        F.log1p(F.col(f"{s}.words")),
        F.log(chars / words),
        F.log1p(100 * F.col(f"{s}.symbols") / chars),
        F.col(f"{s}.upper") / chars,
        F.col(f"{s}.dup_lines") / lines,
        F.col(f"{s}.repeat_words") / words,
        F.col(f"{s}.distinct_words") / words,
        F.log1p(words / lines),
    )


class Projection:
    """Random Fourier features of standardised statistics, with a constant."""

    def __init__(self, mean, spread, size: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = np.asarray(mean), np.asarray(spread)
        self.waves = rng.normal(size=(len(self.mean), size)) / width
        self.phases = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.waves + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])


class Model:
    def __init__(self, project: Projection | None, weights=None, knots=None, values=None):
        self.project, self.weights, self.knots, self.values = project, weights, knots, values

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.project(x) @ self.weights, LOWEST, HIGHEST)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.project is None:
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.knots, self.values)


def isotonic(at: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted cells; the centre and value of each
    pool. Half a row of either class is added to a pool, so no value is 0 or 1."""
    pools: list[list[float]] = []
    for a, k, y in zip(at, n, ones):
        pools.append([a * k, k, y])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    centre = np.array([p[0] / p[1] for p in pools])
    value = np.array([(p[2] + 0.5) / (p[1] + 1) for p in pools])
    return centre, np.maximum.accumulate(value)


def _labelled(stats: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """features, y and part (fit or calibrate) of the rows to learn from."""
    known = labels.where(F.col(label).isNotNull()).select(
        F.col("doc_id").alias("_label_id"), F.col(label).cast("double").alias("y")
    )
    rows = stats.where(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != held_out)
    part = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(4)) == 0
    return rows.join(known, F.col("doc_id") == F.col("_label_id")).select(
        "features", "y", part.alias("calibrates")
    )


def _normal_equations(rows: DataFrame, project: Projection, size: int) -> np.ndarray:
    """Sum of z z' with y as last column: each partition sends its own sum, cut
    into rows of the matrix, and each row is summed by itself."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 2))
        for batch in batches:
            if len(batch):
                z = project(np.stack(batch["features"].to_numpy()))
                total += z.T @ np.hstack([z, batch["y"].to_numpy()[:, None]])
        if total[-1, -2]:
            yield pd.DataFrame({"i": range(size + 1), "part": list(total)})

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": parts["i"].iloc[:1], "part": [np.sum(np.stack(parts["part"]), axis=0)]})

    schema = "i int, part array<double>"
    summed = rows.mapInPandas(partial, schema).groupBy("i").applyInPandas(whole, schema).collect()
    out = np.zeros((size + 1, size + 2))
    for r in summed:
        out[r["i"]] = r["part"]
    return out


def fit(
    stats: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 3,
    held_out: int = 1,
    size: int = 256,
    width: float = 2.0,
    ridge: float = 1e-4,
    seed: int = 17,
) -> Model:
    """Learn from rows of doc_id and features, and labels of doc_id and ``label``."""
    ship_package(stats.sparkSession)
    rows = stored(_labelled(stats, labels, label, folds, held_out), "classifier-rows")
    sums = [F.avg(F.get("features", F.lit(i))).alias(f"m{i}") for i in range(N_FEATURES)]
    spreads = [F.stddev_pop(F.get("features", F.lit(i))).alias(f"s{i}") for i in range(N_FEATURES)]
    known = rows.agg(F.count("*").alias("n"), *sums, *spreads).first()
    if not known["n"]:
        return Model(None)
    project = Projection(
        [known[f"m{i}"] for i in range(N_FEATURES)],
        [max(known[f"s{i}"], 1e-3) for i in range(N_FEATURES)],
        size, width, seed,
    )
    sums = _normal_equations(rows.where(~F.col("calibrates")), project, size)
    gram, right = sums[:, :-1], sums[:, -1]
    weights = np.linalg.solve(gram + (ridge * gram[-1, -1] + 1e-6) * np.eye(size + 1), right)
    model = Model(project, weights)
    cell = score_with(model.raw, F.col("features"))
    cells = (
        rows.where("calibrates")
        .select(F.round(cell * BINS).cast("int").alias("cell"), "y")
        .groupBy("cell").agg(F.count("*").alias("n"), F.sum("y").alias("ones"))
        .collect()  # at most one row per cell
    )
    cells.sort(key=lambda r: r["cell"])
    if cells:
        model.knots, model.values = isotonic(
            np.array([r["cell"] / BINS for r in cells]),
            np.array([float(r["n"]) for r in cells]),
            np.array([r["ones"] for r in cells]),
        )
    else:  # no row fell to the calibration
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_with(score, vector: Column) -> Column:
    @F.pandas_udf("double")
    def run(vectors: pd.Series) -> pd.Series:
        return pd.Series(score(np.stack(vectors.to_numpy())) if len(vectors) else [], dtype="float64")

    # Not to be computed twice or moved: filters on it stay above it.
    return run.asNondeterministic()(vector)


def statistics(docs: DataFrame, carry: list[str], doc_id: str, text: str) -> DataFrame:
    """row (the carried columns), doc_id, features."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
    )
    return with_statistics(packed, "text").select("row", "doc_id", features().alias("features"))


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted."""
    rows = stored(statistics(docs, [doc_id], doc_id, text).select("doc_id", "features"), "classifier-stats")
    model = fit(rows, labels, **settings)
    scored = rows.select("doc_id", score_with(model.score, F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more. Only statistics go to
    Python, rows stay where they are."""
    ids = labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(doc_id)).distinct()
    # Measured for the labelled rows only.
    known = statistics(only(docs.select(doc_id, text), stored(ids, "classifier-ids"), doc_id), [doc_id], doc_id, text)
    model = fit(known.select("doc_id", "features"), labels, **settings)
    rows = statistics(docs, docs.columns, doc_id, text)
    scored = rows.select("row", score_with(model.score, F.col("features")).alias("score"))
    return scored.where("score >= 0.5").select("row.*")
