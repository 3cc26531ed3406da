"""Quality rules with robust multivariate outliers per language and source.

A base rule fails texts that are too short or repeat themselves. The others are
judged by their statistics: transformed, they form one vector per text, and per
language and source a minimum-covariance-determinant estimate gives centre and
scatter of the ``coverage`` share of the vectors (half of them, and a few more) that
lie closest together. A text whose squared Mahalanobis distance exceeds the
chi-square quantile of ``tail`` is rejected. Everything is DataFrame functions.

Equal texts of a group count as one vector in the estimate, so copies of one text
cannot outvote the others; each copy is judged. The estimate starts from two places:
medians and quartiles, and the shortest half of each feature. Neither starts inside
less than half of the vectors, although where different texts with almost one vector
are a third of a group, a start among them could reach a lower determinant. Each takes two concentration steps (moments of the chosen vectors, distances
of all, the closest share again); the start with the least determinant goes on until
its determinant stops falling, and the least one met is kept. All vectors within the
central ``CENTRAL`` of the chi-square distribution then give the final moments.
Vectors are whole numbers of 1/1024 and sums of them are exact, so reruns agree.
Quantiles come from counts per bin (64 per feature unit, 32 per factor of two of
the distance), which a task adds up before anything is shuffled. A variance that is
estimated below a feature's least deviation is raised to it, so that a statistic that
is the same in nearly all texts does not reject the few that differ a little; any
feature can reject a text alone.

Groups below ``least_rows`` distinct texts are judged with the other small groups of
their language, and if those are few as well, with all that is left.

Defined cases: null and empty texts have zero counts and fail the base rule;
null languages and sources are values of their own; repeated rows count as
often as they occur, once in the estimate; fewer than ``least_rows`` distinct texts
in all reject nothing; no rows give no rows. Extra columns may have any names.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import joined
from .common import stored
from .textstats import with_statistics

UNIT = 1024
FEATURES = ("word_length", "symbol_share", "upper_share", "dup_line_share", "repeat_share")
# Deviation that rounding to 1/UNIT gives a feature; added, so no scatter is singular.
FLOORS = (0.29 / UNIT,) * 5
# Least deviations, where less is estimated: what a few characters, a symbol or two, or
# a line or passage that repeats by chance change in a text of ordinary length.
LEAST = (0.05, 0.15, 0.03, 0.12, 0.06)
D = len(FEATURES)
CENTRAL = 0.975
FALLING = 1e-3  # of half the determinant's logarithm


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1.0 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi_square_cdf(x: float, freedom: int) -> float:
    return _gamma_share(freedom / 2, x / 2) if x > 0 else 0.0


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, freedom) < p else (low, mid)
    return (low + high) / 2


def base_failed(s: str = "stats") -> Column:
    words, repeated = F.col(f"{s}.words"), F.col(f"{s}.repeat_words")
    return (words < 20) | (100 * repeated > 30 * words)


def _vector(s: str = "stats") -> Column:
    """The transformed statistics as whole numbers of 1/1024."""
    words = F.greatest(F.col(f"{s}.words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(f"{s}.lines"), F.lit(1)).cast("double")
    parts = (
        F.log(chars / words),
        F.log1p(100 * F.col(f"{s}.symbols") / chars),
        F.col(f"{s}.upper") / chars,
        F.col(f"{s}.dup_lines") / lines,
        F.col(f"{s}.repeat_words") / words,
    )
    return F.array(*[F.round(p * UNIT).cast("long") for p in parts])


def measured(docs: DataFrame, carry: list[str], text: str, lang: str, source: str) -> DataFrame:
    """row (the carried columns), stats, lang, source, copy (of the text), vector."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"),
    )
    return (
        with_statistics(packed, "text")
        .withColumn("copy", F.xxhash64("text"))
        .drop("text")
        .withColumn("failed", base_failed())
        .withColumn("vector", _vector())
    )


def _groups(rows: DataFrame, least_rows: int) -> DataFrame:
    """lang, source, group, for every pair that has vectors."""
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < least_rows
    in_lang = Window.partitionBy("lang", small)
    left = Window.partitionBy(F.col("few"))
    return (
        counts.withColumn("in_lang", F.sum("n").over(in_lang))
        .withColumn("few", small & (F.col("in_lang") < least_rows))
        .withColumn("rest", F.sum("n").over(left))
        .where(~F.col("few") | (F.col("rest") >= least_rows))
        .select(
            "lang", "source",
            F.when(F.col("few"), F.lit("rest"))
            .when(small, F.concat(F.lit("lang "), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null"))))
            .otherwise(
                F.concat_ws(
                    " ", F.lit("pair"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")),
                    F.length("lang").cast("string"),
                    F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")),
                )
            )
            .alias("group"),
        )
    )


def _x(i: int) -> Column:
    return F.get("vector", F.lit(i))


def _first_bin(counted: DataFrame, keys: list[str], needs: list) -> DataFrame:
    """Per key and need (rows out of all), the lowest bin up to which as many lie."""
    each = Window.partitionBy(*keys)
    up_to = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("up_to", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(each))
    return reached.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("up_to") >= need(F.col("all")), F.col("bin"))).alias(f"b{k}")
            for k, need in enumerate(needs)
        ]
    )


def _distance(c: str = "p") -> Column:
    """Squared length of (triangle x (vector - centre))."""
    centred = [_x(i).cast("double") - F.get(f"{c}.centre", F.lit(i)) for i in range(D)]
    total = []
    for i in range(D):
        terms = [F.get(f"{c}.triangle", F.lit(i * (i + 1) // 2 + j)) * centred[j] for j in range(i + 1)]
        total.append(reduce(add, terms))
    return reduce(add, [t * t for t in total])


GRID = 20  # a feature's quantiles that the starts look at


def _start(rows: DataFrame) -> DataFrame:
    """group, start, p: centres and diagonal triangles from medians and quartiles, and
    from the shortest half of each feature, by a grid of quantiles."""
    long = rows.select(
        "group", F.posexplode(F.transform("vector", lambda v: F.floor(v / F.lit(UNIT // 64)))).alias("f", "bin")
    )
    counted = long.groupBy("group", "f", "bin").agg(F.count("*").alias("n"))
    needs = [lambda n, k=k: F.ceil(n * k / GRID) for k in range(GRID + 1)]
    points = _first_bin(counted, ["group", "f"], needs)
    floors = F.array(*[F.lit(s * UNIT) for s in LEAST])

    def placed(middle: Column, width: Column) -> Column:
        """``width``: of what is 1.349 deviations where vectors are normal."""
        spread = F.greatest(width * (UNIT / 64 / 1.349), F.get(floors, F.col("f")))
        return F.struct("f", ((middle + 0.5) * (UNIT // 64)).alias("m"), (1 / spread).alias("w"))

    half = GRID // 2
    spans = [
        F.struct((F.col(f"b{k + half}") - F.col(f"b{k}")).alias("width"), F.lit(abs(2 * k - half)).alias("off"),
                 (F.col(f"b{k + half}") + F.col(f"b{k}")).alias("ends"))
        for k in range(GRID + 1 - half)
    ]
    least = F.array_min(F.array(*spans))
    starts = [
        placed(F.col(f"b{half}").cast("double"), F.col(f"b{3 * half // 2}") - F.col(f"b{half // 2}")),
        placed(least["ends"] / 2, least["width"]),
    ]
    features = points.select("group", F.posexplode(F.array(*starts)).alias("start", "feature"))
    start = features.groupBy("group", "start").agg(  # one entry per feature
        F.array_sort(F.collect_list("feature")).alias("s")
    )
    triangle = [
        F.get("s.w", F.lit(i)) if i == j else F.lit(0.0) for i in range(D) for j in range(i + 1)
    ]
    return start.select(
        "group", "start", F.struct(F.col("s.m").alias("centre"), F.array(*triangle).alias("triangle")).alias("p")
    )


def _moments(chosen: DataFrame, keys: tuple = ("group",)) -> DataFrame:
    """Exact sums of the chosen vectors and of their products, per group."""
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = [exact(_x(i)).alias(f"s{i}") for i in range(D)]
    products = [exact(_x(i) * _x(j)).alias(f"s{i}_{j}") for i in range(D) for j in range(i + 1)]
    return chosen.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)


def _estimate(moments: DataFrame, scale: float, keys: tuple = ("group",)) -> DataFrame:
    """Centre and the inverse of the scatter's Cholesky factor, and half the logarithm
    of the scatter's determinant, per group."""
    table = moments.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / F.col("n") for i in range(D)})
    spreads = {}
    for i in range(D):
        for j in range(i + 1):
            spread = F.col(f"s{i}_{j}").cast("double") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            if i == j:
                spread = F.greatest(spread * scale, F.lit((LEAST[i] * UNIT) ** 2)) + (FLOORS[i] * UNIT) ** 2
            else:
                spread = spread * scale
            spreads[f"c{i}_{j}"] = spread
    table = table.withColumns(spreads)
    for j in range(D):
        used = [F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]
        table = table.withColumn(f"l{j}_{j}", F.sqrt(reduce(lambda a, b: a - b, used, F.col(f"c{j}_{j}"))))
        below = {}
        for i in range(j + 1, D):
            used = [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]
            below[f"l{i}_{j}"] = reduce(lambda a, b: a - b, used, F.col(f"c{i}_{j}")) / F.col(f"l{j}_{j}")
        table = table.withColumns(below) if below else table
    for i in range(D):
        row = {f"t{i}_{i}": 1 / F.col(f"l{i}_{i}")}
        for j in range(i):
            used = [F.col(f"l{i}_{k}") * F.col(f"t{k}_{j}") for k in range(j, i)]
            row[f"t{i}_{j}"] = -reduce(add, used) / F.col(f"l{i}_{i}")
        table = table.withColumns(row)
    return table.select(
        *keys,
        F.struct(
            F.array(*[F.col(f"m{i}") for i in range(D)]).alias("centre"),
            F.array(*[F.col(f"t{i}_{j}") for i in range(D) for j in range(i + 1)]).alias("triangle"),
        ).alias("p"),
        reduce(add, [F.log(f"l{i}_{i}") for i in range(D)]).alias("det"),
    )


def _concentrated(vectors: DataFrame, params: DataFrame, coverage: float) -> DataFrame:
    """group, start, p, det after one concentration step of each row of ``params``."""
    keys = ("group", "start")
    within = chi_square_quantile(coverage, D)
    scale = coverage / chi_square_cdf(within, D + 2)
    bins = F.floor(32 * F.log2(_distance() + F.lit(1e-6))).cast("int")
    far = joined(vectors, params.select(*keys, "p"), ["group"]).select(*keys, "vector", bins.alias("bin"))
    counted = far.groupBy(*keys, "bin").agg(F.count("*").alias("n"))

    def share(n: Column) -> Column:
        return F.greatest(F.ceil(n * coverage), F.floor((n + D + 1) / 2))

    cut = stored(_first_bin(counted, list(keys), [share]), "rule-cut")
    chosen = joined(far, cut, list(keys)).where(F.col("bin") <= F.col("b0"))
    return stored(_estimate(_moments(chosen, keys), scale, keys), "rule-step")


def _least(vectors: DataFrame, starts: DataFrame, coverage: float, steps: int) -> DataFrame:
    """group, p with the least determinant that concentration reaches."""
    tried = starts
    for _ in range(2):
        tried = _concentrated(vectors, tried, coverage)
    first = F.min(F.struct("det", "start", "p")).alias("best")
    best = stored(tried.groupBy("group").agg(first, F.lit(True).alias("moved")), "rule-best")
    for _ in range(steps - 2):
        moving = best.where("moved").select("group", "best.start", "best.p")
        if moving.isEmpty():
            break
        step = _concentrated(vectors, moving, coverage).select("group", F.struct("det", "start", "p").alias("next"))
        fell = F.coalesce(F.col("next.det") < F.col("best.det") - FALLING, F.lit(False))
        best = stored(
            best.join(step, "group", "left").select(
                "group", F.when(fell, F.col("next")).otherwise(F.col("best")).alias("best"), fell.alias("moved")
            ),
            "rule-best",
        )
    return best.select("group", "best.p")


def estimates(
    rows: DataFrame, coverage: float = 0.5, steps: int = 50, least_rows: int = 50
) -> DataFrame:
    """lang, source, p (centre, triangle), from rows of lang, source, vector and, if
    equal texts are to count once, copy. ``steps`` stops a determinant that falls
    without end; with 0, medians and quartiles are the estimate."""
    if "copy" in rows.columns:
        rows = stored(rows.select("lang", "source", "copy", "vector").distinct(), "rule-texts")
    groups = stored(_groups(rows, least_rows), "rule-groups")
    vectors = stored(
        joined(rows, groups, ["lang", "source"]).select("group", "vector"), "rule-vectors"
    )
    starts = stored(_start(vectors), "rule-step")
    if steps == 0:
        return groups.join(starts.where("start = 0"), "group").select("lang", "source", "p")
    params = _least(vectors, starts, coverage, steps)
    within = chi_square_quantile(CENTRAL, D)
    central = joined(vectors, params, ["group"]).where(_distance() <= F.lit(within))
    params = stored(_estimate(_moments(central), CENTRAL / chi_square_cdf(within, D + 2)), "rule-step")
    return groups.join(params, "group").select("lang", "source", "p")


def judged(rows: DataFrame, params: DataFrame, tail: float = 0.001) -> DataFrame:
    """Add distance (null where nothing was estimated), cutoff and kept."""
    cutoff = chi_square_quantile(1 - tail, D)
    return (
        joined(rows, params, ["lang", "source"], "left")
        .withColumn("distance", _distance())
        .withColumn(
            "kept", ~F.col("failed") & F.coalesce(F.col("distance") <= F.lit(cutoff), F.lit(True))
        )
        .drop("p")
    )


def apply_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    tail: float = 0.001,
    **settings,
) -> DataFrame:
    """Per row of ``docs``: row.doc_id, stats, failed, distance, kept."""
    rows = stored(measured(docs, [doc_id], text, lang, source), "rule-rows")
    fitted = estimates(rows.where(~F.col("failed")).select("lang", "source", "copy", "vector"), **settings)
    return judged(rows, stored(fitted, "rule-estimates"), tail)


def keep_good(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    tail: float = 0.001,
    **settings,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are measured twice, once
    for the estimates and once beside their row, and never shuffled for it
    unless the estimates outgrow a broadcast."""
    rows = measured(docs, [lang], text, lang, source).where(~F.col("failed"))
    rows = rows.select("lang", "source", "copy", "vector")
    params = stored(estimates(rows, **settings), "rule-estimates")
    return judged(measured(docs, docs.columns, text, lang, source), params, tail).where("kept").select("row.*")

