"""Duplicates, lengths, labels, splits, augmentation."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from desksort.operators.augment import add_synthetic, common_columns
from desksort.operators.dedup import drop_duplicate_rows, duplicates_removed
from desksort.operators.labels import (
    build_label_map, categories_in_order, decode, encode, label_mapping_record,
)
from desksort.operators.outliers import band_stats, keep_band, length_band
from desksort.operators.profile import class_weights, split_counts, value_counts
from desksort.operators import quantiles
from desksort.operators.quantiles import exact_quantiles, order_key
from desksort.operators.split import split_quotas, stratified_split
from tests.conftest import plan

ROWS = [
    (1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, None, "a"), (5, "a", None),
    (6, "", "x"), (7, None, "x"), (8, "ab", "c"), (9, "a", "bc"), (10, "a", "x"), (11, "-", "-"),
    (12, None, None), (13, "1:a", ""), (14, "", "1:a"),
]


def test_copies_by_keep(spark):
    df = spark.createDataFrame(ROWS, "o long, t string, d string")
    kept = {
        keep: {r["o"] for r in drop_duplicate_rows(df, ["t", "d"], "o", keep).collect()}
        for keep in ("first", "last", False)
    }
    alone = {4, 6, 7, 8, 9, 11, 12, 13, 14}
    assert kept["first"] == alone | {1, 3}
    assert kept["last"] == alone | {10, 5}
    assert kept[False] == alone
    assert duplicates_removed(df, ["t", "d"], "o").first()["removed"] == 3
    assert duplicates_removed(df, ["t", "d"], "o", False).first()["removed"] == 5
    with pytest.raises(ValueError, match="keep"):
        drop_duplicate_rows(df, ["t"], "o", "some")


def test_a_third_of_all_rows_being_copies_is_combined_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("t")
    )
    kept = drop_duplicate_rows(df, ["t"], "id")
    assert kept.count() == 20_001
    text = plan(kept)
    assert "partial_min" in text and "Window" not in text and "collect_" not in text


def test_band_is_the_interpolated_one(spark):
    lengths = [int(v) for v in np.random.default_rng(5).integers(1, 4000, 777)]
    df = spark.createDataFrame([(v,) for v in lengths], "n int")
    band = length_band(df, "n")
    low, high = np.quantile(lengths, [0.01, 0.99])
    assert band.first() == (pytest.approx(low, abs=1e-9), pytest.approx(high, abs=1e-9))
    inside = [v for v in lengths if low <= v <= high]
    assert sorted(r["n"] for r in keep_band(df, "n", band).collect()) == sorted(inside)
    stats = band_stats(df, "n", band).first()
    assert stats["removed"] == 777 - len(inside) == stats["too_short"] + stats["too_long"]


def test_keys_are_in_the_order_of_the_doubles(spark):
    rng = np.random.default_rng(3)
    edges = [2.0**e for e in range(-1074, 1024)]
    values = [*edges, *np.nextafter(edges, 0), *np.nextafter(edges, np.inf), np.inf, 0.0]
    values += rng.integers(0, 2**62, 3000).view(np.float64).tolist()
    values = [float(v) for v in values if not math.isnan(v)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in [*values, math.nan]], "x double")
    keys = {r["x"]: r["k"] for r in df.select("x", order_key(F.col("x")).alias("k")).collect() if not math.isnan(r["x"])}
    for v, k in keys.items():
        bits = int(np.float64(abs(v)).view(np.int64))
        assert k == (-bits if v < 0 else bits)
    assert df.select(F.max(order_key(F.col("x")))).first()[0] == 0x7FF8 << 48


@pytest.mark.parametrize("values", [
    [2.0**e for e in range(-500, 500)],
    [float(v) for v in range(3000)],
    [math.inf, -math.inf, *np.random.default_rng(1).normal(size=2000), -0.0, 0.0],
])
def test_quantiles_take_few_counts(spark, monkeypatch, values):
    counts = []
    monkeypatch.setattr(quantiles, "_counted", lambda *a, f=quantiles._counted: counts.append(1) or f(*a))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    wanted = [0.1, 0.25, 0.5, 0.9, 0.99]
    got = {r["quantile"]: r["value"] for r in exact_quantiles(df, "x", wanted).collect()}
    assert got == {q: pytest.approx(np.quantile(values, q), rel=1e-12) for q in wanted}
    assert len(counts) <= 4


def test_quantiles_of_crowded_ranges(spark, monkeypatch):
    """Cells with more rows than buckets are counted by bits, not by value."""
    monkeypatch.setattr(quantiles, "BITS", 4)
    values = (1 + np.random.default_rng(2).random(3000) * 2.0**-30).tolist()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["quantile"]: r["value"] for r in exact_quantiles(df, "x", [0.0, 0.3, 1.0]).collect()}
    assert got == {q: np.quantile(values, q) for q in (0.0, 0.3, 1.0)}


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(7)
    # A hot value, a long tail, and a group of one row.
    groups = {
        "hot": np.concatenate([np.full(3000, 0.97), rng.beta(8, 2, 6000)]),
        "tail": rng.pareto(1.0, 5000),
        "one": np.array([0.25]),
        "two": np.array([1.0, 2.0]),
        "far": np.array([-1e300, -5.0, 0.0, 1e-300, 2e-300, 1e300]),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    wanted = [0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {
        (r["g"], r["quantile"]): r["value"]
        for r in exact_quantiles(df, "x", wanted, by=["g"]).collect()
    }
    assert got == {
        (g, q): pytest.approx(np.quantile(vs, q), rel=1e-12)
        for g, vs in groups.items()
        for q in wanted
    }
    whole = exact_quantiles(df, "x", [0.5]).first()["value"]
    assert whole == pytest.approx(np.median([v for _, v in rows if v is not None]), rel=1e-12)


def test_labels_follow_the_alphabet(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("Z",), (None,)], "category string")
    known = build_label_map(df)
    assert categories_in_order(known) == ["Z", "a", "b"]
    other = spark.createDataFrame([("a",), ("new",), (None,)], "category string")
    coded = {r["category"]: r["label"] for r in encode(other, known).collect()}
    assert coded == {"a": 1, "new": None, None: None}
    assert decode(encode(df, known).drop("category"), known).where("category = 'b'").count() == 2
    record = label_mapping_record(known).first().asDict(recursive=True)
    assert record == {
        "label_to_id": {"Z": 0, "a": 1, "b": 2}, "id_to_category": {"0": "Z", "1": "a", "2": "b"},
        "num_classes": 3,
    }


def largest_remainder(sizes, draws):
    total = sum(sizes.values())
    share = {k: divmod(n * draws, total) for k, n in sizes.items()}
    out = {k: q for k, (q, _) in share.items()}
    spare = draws - sum(out.values())
    for k in sorted(share, key=lambda k: (-share[k][1], k))[:spare]:
        out[k] += 1
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 7, "c": 3}, {"a": 1, "b": 1, "c": 98}, {"x": 5}, {"a": 333, "b": 333, "c": 334}],
)
def test_quotas(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "s string, n long")
    got = {r["s"]: (r["train"], r["val"], r["test"]) for r in split_quotas(df, "s", "n").collect()}
    n = sum(sizes.values())
    held_n = int(np.ceil(0.3 * n))
    train = largest_remainder(sizes, n - held_n)
    held = {k: sizes[k] - train[k] for k in sizes}
    val = largest_remainder(held, held_n - int(np.ceil(0.5 * held_n)))
    assert got == {k: (train[k], val[k], held[k] - val[k]) for k in sizes}


def test_quotas_reproduce_recorded_held_out_sizes(spark):
    """Support of the held-out classes, known from a published evaluation."""
    held = [4118, 894, 2343, 1819, 2502, 1393, 362, 547, 94]
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(held)], "s string, n long")
    quotas = split_quotas(df, "s", "n", held_out=0.5).collect()
    assert sum(r["train"] for r in quotas) == 7036
    assert all(abs(2 * r["train"] - r["n"]) <= 1 for r in quotas)


def test_split_sizes_hold_whatever_the_slices(spark):
    # One stratum holds a third of all rows.
    df = spark.range(3000).select(
        F.concat(F.lit("t"), "id").alias("tid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("c"),
    )
    parts = {
        d: {r["tid"]: r["split"] for r in stratified_split(df, "c", "tid", digits=d).collect()}
        for d in (0, 1, 3)
    }
    assert parts[0] == parts[1] == parts[3] and len(parts[3]) == 3000
    classes = {r["tid"]: r["c"] for r in df.collect()}
    got = Counter((classes[t], s) for t, s in parts[3].items())
    sizes = df.groupBy("c").agg(F.count("*").alias("n"))
    for r in split_quotas(sizes, "c", "n").collect():
        assert [got[r["c"], s] for s in ("train", "val", "test")] == [r["train"], r["val"], r["test"]]
    other = {r["tid"]: r["split"] for r in stratified_split(df, "c", "tid", seed=1).collect()}
    assert other != parts[3]


@pytest.mark.parametrize("ranked", [10, 10_000])
def test_quotas_are_exact_when_ids_repeat(spark, ranked):
    rows = [("a", 7 if i < 100 else i, i) for i in range(200)]
    rows += [("b", 1, i) for i in range(50)] + [("c", None, i) for i in range(20)] + [(None, i, i) for i in range(10)]
    df = spark.createDataFrame(rows, "c string, tid long, n long").repartition(6)
    out = stratified_split(df, "c", "tid", ranked=ranked)
    assert out.columns == ["c", "tid", "n", "split"]
    got = Counter((r["c"], r["split"]) for r in out.collect())
    assert sum(got.values()) == len(rows) and {r["n"] for r in out.where("c = 'a'").collect()} == set(range(200))
    for r in split_quotas(df.groupBy("c").agg(F.count("*").alias("size")), "c", "size").collect():
        assert [got[r["c"], s] for s in ("train", "val", "test")] == [r["train"], r["val"], r["test"]]
    alone = stratified_split(df.where("c = 'a'"), "c", "tid", ranked=ranked)
    assert Counter(r["split"] for r in alone.collect()) == {"train": 140, "val": 30, "test": 30}


def test_split_moves_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(id % 3 as string) c", "repeat('x', 50) body").write.parquet(path)
    df = stratified_split(spark.read.parquet(path), "c", "id")
    above = plan(df.select("id", "body", "split"))
    # The texts go from the scan straight through a broadcast join.
    assert "SortMergeJoin" not in above.split("body")[0]
    scans = [line for line in above.splitlines() if "ReadSchema" in line]
    assert sum("body" in line.split("ReadSchema")[1] for line in scans) == 1
    for line in above.splitlines():
        if "Exchange hashpartitioning" in line or "Window" in line:
            assert "body" not in line


def test_synthetic_rows_lose_to_originals(spark):
    train = spark.createDataFrame(
        [(5, "t1", "d1", "train", "A"), (6, "t2", "d2", "train", "A")],
        "ordinal long, title string, description string, split string, category string",
    )
    extra = spark.createDataFrame(
        [(1, "t1", "d1", "B"), (2, "new", "d", "B"), (3, "new", "d", "C"), (4, None, "d", "C")],
        "ordinal long, title string, description string, category string",
    )
    assert common_columns(train, extra) == ["ordinal", "title", "description", "category"]
    got = add_synthetic(train, extra).collect()
    assert {(r["ordinal"], r["category"], r["is_synthetic"]) for r in got} == {
        (5, "A", False), (6, "A", False), (2, "B", True), (4, "C", True)
    }
    with pytest.raises(ValueError, match="order"):
        add_synthetic(train, extra.drop("ordinal"))


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "split string, category string")
    counts = value_counts(df, "split").collect()
    assert [(r["split"], r["count"]) for r in counts] == [("a", 2), ("b", 1)]
    assert sum(r["percentage"] for r in counts) == pytest.approx(100)
    totals = {(r["split"], r["category"]): r["count"] for r in split_counts(df.dropna()).collect()}
    assert totals[None, None] == 3 and totals["a", None] == 2 and totals["b", "x"] == 1
    weights = {r["category"]: r["weight"] for r in class_weights(df, "category").collect()}
    assert weights == {"x": pytest.approx(4 / (2 * 3)), "y": pytest.approx(2.0)}
