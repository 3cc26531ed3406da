import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import SparseVector

from desksort.operators import solver
from desksort.operators.classifier import fit_multinomial

FEATURES = 300


def vectors(spark, labels, rows=1200, seed=1):
    """Rows with a few frequent, correlated places and many rare ones; one row is empty."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(rows):
        label = labels[i % len(labels)]
        often = {c for c in range(12) if rng.random() < (0.9 if i % 3 else 0.7)}
        rare = set(rng.integers(12, FEATURES, 15).tolist())
        at = sorted(often | rare | ({20 + label} if rng.random() < 0.3 else set())) if i else []
        values = rng.random(len(at)) + 0.2
        out.append((float(label), 1.0 + label / 4, SparseVector(FEATURES, at, values / max(np.linalg.norm(values), 1e-9))))
    return spark.createDataFrame(out, ["label", "weight", "features"]).repartition(3).cache()


def plain(n, tol):
    return LogisticRegression(
        family="multinomial", weightCol="weight", regParam=1.0 / n, elasticNetParam=0.0,
        standardization=False, maxIter=1000, tol=tol,
    )


def test_solver_reaches_the_optimum_in_fewer_passes(spark, monkeypatch):
    rows = vectors(spark, [0, 1, 2])
    n = rows.count()
    exact, usual = plain(n, 1e-13).fit(rows), plain(n, 1e-6).fit(rows)
    passes = []
    whole = solver._summed
    monkeypatch.setattr(solver, "_summed", lambda *args: passes.append(1) or whole(*args))
    made = fit_multinomial(plain(n, 1e-6), rows, FEATURES)
    # Spark's own solver takes a pass for each step at least.
    assert len(passes) < usual.summary.totalIterations
    assert np.abs(made.coefficientMatrix.toArray() - exact.coefficientMatrix.toArray()).max() < 0.02
    assert np.abs(made.interceptVector.toArray() - exact.interceptVector.toArray()).max() < 0.02
    said = made.transform(rows).select("probability", "prediction").collect()
    true = exact.transform(rows).select("probability").collect()
    apart = max(np.abs(a["probability"].toArray() - b["probability"].toArray()).max() for a, b in zip(said, true))
    assert apart < 0.005 and {r["prediction"] for r in said} <= {0.0, 1.0, 2.0}


@pytest.mark.parametrize("block", [0, 5, FEATURES])
def test_any_block_has_the_same_optimum(spark, block):
    rows = vectors(spark, [0, 1, 2], 300)
    found, _, losses = solver.solve(rows, 3, FEATURES, 375.0, 1 / 300, tolerance=1e-9, block=block)
    exact = plain(300, 1e-13).fit(rows).coefficientMatrix.toArray()
    assert np.abs(found - exact).max() < 1e-3
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))


def test_labels_that_are_missing_or_alone(spark, tmp_path):
    gap = fit_multinomial(plain(60, 1e-6), vectors(spark, [0, 2], 60), FEATURES)
    assert gap.numClasses == 3 and np.isfinite(gap.interceptVector.toArray()).all()
    rows = vectors(spark, [0, 2], 60)
    assert rows.count() == gap.transform(rows).where("prediction <> 1").count()
    gap.write().overwrite().save(str(tmp_path / "m"))
    again = LogisticRegressionModel.load(str(tmp_path / "m"))
    assert (again.coefficientMatrix.toArray() == gap.coefficientMatrix.toArray()).all()
    alone = vectors(spark, [1], 30)
    one = fit_multinomial(plain(30, 1e-6), alone, FEATURES)
    assert {r["prediction"] for r in one.transform(alone).collect()} == {1.0}
