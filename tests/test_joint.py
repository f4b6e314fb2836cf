"""Joint fits equal the single ones."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from triagekit.operators import joint as JT
from triagekit.operators import models as MD


def data(seed, n, d):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.integers(0, 2, size=(n, d))
    y = (x @ rng.normal(size=d) + rng.normal(size=n) > 0.4).astype(int)
    return x, y


@pytest.mark.parametrize("penalty,strengths", [("l2", [1.0, 0.1, 10.0]), ("l1", [1.0, 0.2]), ("none", [1.0])])
def test_joint_weights_equal_single_fits(spark, penalty, strengths):
    sets, rows = [data(1, 120, 4), data(2, 90, 6)], None
    sizes, cs, singles = [], [], []
    for i, (x, y) in enumerate(sets):
        df = spark.createDataFrame([(int(t), Vectors.sparse(x.shape[1], np.flatnonzero(v), v[v != 0])) for v, t in zip(x, y)],
                                   ["escalated", "features"])
        df = MD.balanced_weights(df)
        for c in strengths:
            b = len(sizes)
            sizes.append(JT.width(df))
            cs.append(c)
            spec = MD.ModelSpec("m", "lr", {"penalty": penalty, "C": None if penalty == "none" else c})
            est = spec.estimator(float(len(y))).setTol(1e-10)
            singles.append(MD.InterceptPenalisedLR.fit(est, df, "escalated"))
            part = JT.padded(df, x.shape[1], 6).selectExpr(f"{b} as block", "escalated", "w", "_aug", "features")
            rows = part if rows is None else rows.unionByName(part)
    joint = JT.JointLogistic(sizes, cs, penalty, tol=1e-9).fit(rows)
    for b, single in enumerate(singles):
        w = joint.weights(b)
        assert np.allclose(w.coefficients.toArray(), single.coefficients.toArray(), atol=1e-4)
        assert w.intercept == pytest.approx(single.intercept, abs=1e-4)
    row = joint.transform(rows.where("block = 0")).select("features", "y_prob").first()
    w = joint.weights(0)
    assert row.y_prob == pytest.approx(1 / (1 + np.exp(-(row.features.dot(w.coefficients.toArray()) + w.intercept))))


def test_balanced_weights_per_key(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (0, 0), (1, 1), (1, 0)], "fold int, escalated int")
    got = {(r.fold, r.escalated): r.w for r in JT.balanced(df, ["fold"]).collect()}
    assert got == {(0, 1): 1.5, (0, 0): 0.75, (1, 1): 1.0, (1, 0): 1.0}
