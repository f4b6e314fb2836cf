"""Newton's fits against MLlib's solver on the same objective, and their number of jobs."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from triagekit.operators import joint as JT
from triagekit.operators import models as MD
from triagekit.operators import newton as NT


def table(spark, n=300, d=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.integers(0, 2, size=(n, d)) * np.logspace(0, -2, d)
    y = (x @ (rng.normal(size=d) / np.logspace(0, -2, d)) + rng.normal(size=n) > 0.4).astype(int)
    return spark.createDataFrame([(int(t), Vectors.dense(v)) for v, t in zip(x, y)], ["escalated", "features"]).repartition(3)


@pytest.mark.parametrize("penalty,c", [("l2", 1.0), ("l2", 10.0), ("l1", 1.0), ("none", None)])
def test_newton_equals_mllib(spark, penalty, c):
    df = MD.balanced_weights(table(spark)).cache()
    est = MD.ModelSpec("m", "lr", {"penalty": penalty, "C": c}).estimator(300.0)
    got = MD.InterceptPenalisedLR.fit(est, df, "escalated")
    want = MD.InterceptPenalisedLR._fit_wide(est.copy().setTol(1e-12).setMaxIter(5000), df, "escalated", "features")
    assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), atol=2e-3, rtol=1e-3)
    assert got.intercept == pytest.approx(want.intercept, abs=1e-3)
    a, b = (m.transform(df).select("features", MD.vector_to_array("probability")[1].alias("p"), "prediction").collect()
            for m in (got, want))
    assert np.allclose([r.p for r in a], [r.p for r in b], atol=1e-3)
    assert [r.prediction for r in a] == [float(r.p > 0.5) for r in a]


def test_few_steps(spark, monkeypatch):
    """One job over the rows a step; MLlib's solver takes hundreds on features of unlike scale."""
    steps, sums = [], NT._sums
    monkeypatch.setattr(NT, "_sums", lambda *a: steps.append(1) or sums(*a))
    df = MD.balanced_weights(table(spark))
    MD.InterceptPenalisedLR.fit(MD.ModelSpec("m", "lr", {"C": 100.0}).estimator(300.0), df, "escalated")
    assert len(steps) <= 15


def test_missing_label_is_refused(spark):
    df = table(spark, 20).withColumn("escalated", F.when(F.rand(1) < 0.5, F.col("escalated")))
    with pytest.raises(Exception, match="lacks its label"):
        MD.InterceptPenalisedLR.fit(MD.reference_models()[0].estimator(20.0), df.withColumn("w", F.lit(1.0)), "escalated")


def test_wide_blocks_equal_newton(spark, monkeypatch):
    """Blocks wider than a Newton step holds go to MLlib, with the same weights."""
    df = MD.balanced_weights(table(spark, 120, 3))
    rows = JT.padded(df, 3, 3).selectExpr("0 as block", "escalated", "w", "_aug").cache()
    fits = [JT.JointLogistic([3], [2.0], tol=1e-9).fit(rows)]
    monkeypatch.setattr(NT, "MOST_FEATURES", 2)
    fits.append(JT.JointLogistic([3], [2.0], tol=1e-9).fit(rows))
    assert not fits[0].wide and fits[1].wide
    a, b = (f.weights(0).coefficients.toArray()[:3] for f in fits)
    assert np.allclose(a, b, atol=1e-4)
    p, q = ([r.y_prob for r in f.transform(rows).select("y_prob").collect()] for f in fits)
    assert np.allclose(p, q, atol=1e-4)
