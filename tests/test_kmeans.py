"""Joint K-Means: equal to single fits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from triagekit.operators import models as MD


def test_joint_kmeans_equals_single_fits(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) + rng.integers(0, 4, 300)[:, None] * 3.0
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "a array<double>").repartition(4).select(array_to_vector("a").alias("pcs")).cache()
    rows.count()
    best = MD.kmeans_best(rows, [2, 5], "pcs", 3)
    for k in (2, 5):
        singles = [KMeans(k=k, featuresCol="pcs", seed=MD.C.SEED + s, maxIter=300, tol=1e-4).fit(rows) for s in range(3)]
        single = min(singles, key=lambda m: m.summary.trainingCost)
        model, cost = best[k]
        assert cost == pytest.approx(single.summary.trainingCost, rel=1e-9)
        assert np.allclose(model.centres, np.array(single.clusterCenters()), atol=1e-9)
        both = single.transform(rows).groupBy("prediction").count().collect()
        assert {(r["prediction"], r["count"]) for r in both} == {
            (r["cluster"], r["count"]) for r in model.transform(rows).groupBy("cluster").count().collect()}
