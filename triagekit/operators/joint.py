"""Many logistic regressions in one fit.

Every training set (a fold, a training size, a penalty strength) is a block of
its own: one run of Newton steps (``operators.newton``) solves all of them, in
the jobs of one.

Blocks wider than those steps can hold are one MLlib fit. A row's features, with
a constant behind them for the intercept, are moved to its block's place in one
long sparse vector, so that no weight sees rows of two blocks and the joint
objective is the sum of the blocks' objectives. There a block's strength enters
as a scale. Under an L2 penalty a block with strength C has its rows multiplied
by sqrt(C / C0), under L1 by C / C0, and its weights come out divided by it;
then one penalty of strength C0 is right for all. The intercept is penalised
like the other weights: the sign of a row and of its label are flipped together
for a hash-chosen half of the rows, which leaves the loss as it is and lets the
constant vary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Interaction, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import newton as NT

TOLERANCE = 1e-6


@dataclass(frozen=True)
class Weights:
    """Weights of one block in its own features."""
    coefficients: DenseVector
    intercept: float


def width(df: DataFrame, features: str = "features") -> int:
    """Size of the feature vectors, from the column's metadata or its first row (0 without rows)."""
    known = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return int(known)
    row = df.select(features).first()
    return row[0].size if row else 0


def padded(df: DataFrame, size: int, longest: int, features: str = "features", out: str = "_aug") -> DataFrame:
    """Features of ``size``, a constant 1 and zeros up to ``longest`` + 1 places."""
    parts = [features, "_one"]
    x = VectorSizeHint(inputCol=features, size=size, handleInvalid="optimistic").transform(df.withColumn("_one", F.lit(1.0)))
    if longest > size:
        x = x.withColumn("_pad", array_to_vector(F.array_repeat(F.lit(0.0), longest - size)))
        x = VectorSizeHint(inputCol="_pad", size=longest - size, handleInvalid="optimistic").transform(x)
        parts.append("_pad")
    return VectorAssembler(inputCols=parts, outputCol=out).transform(x).drop("_one", "_pad")


class JointLogistic:
    """``fit`` on rows ``block, label, weight, _aug``; ``transform`` adds ``y_prob`` to rows with ``block`` and ``_aug``."""

    def __init__(self, sizes: list[int], strengths: list[float], penalty: str = "l2", max_iter: int = 1000,
                 tol: float = TOLERANCE):
        self.sizes, self.longest, self.penalty, self.max_iter, self.tol = sizes, max(sizes), penalty, max_iter, tol
        self.strengths, self.wide = strengths, self.longest + 1 > NT.MOST_FEATURES
        if penalty == "none":
            self.base, self.scales = None, [1.0] * len(sizes)
        else:
            self.base = float(np.exp(np.mean(np.log(strengths))))
            power = 0.5 if penalty == "l2" else 1.0
            self.scales = [float((c / self.base) ** power) for c in strengths]

    def _moved(self, df: DataFrame, sign: Column) -> DataFrame:
        scale = F.element_at(F.array(*[F.lit(s) for s in self.scales]), F.col("block") + 1) * sign
        places = F.transform(F.sequence(F.lit(0), F.lit(len(self.sizes) - 1)),
                             lambda i: F.when(i == F.col("block"), scale).otherwise(F.lit(0.0)))
        x = df.withColumn("_place", array_to_vector(places))
        x = VectorSizeHint(inputCol="_place", size=len(self.sizes), handleInvalid="optimistic").transform(x)
        x = VectorAssembler(inputCols=["_place"], outputCol="_block").transform(x)
        return Interaction(inputCols=["_block", "_aug"], outputCol="_joint").transform(x).drop("_place", "_block")

    def fit(self, rows: DataFrame, label: str = "escalated", weight: str = "w") -> JointLogistic:
        if not self.wide:
            penalties = [0.0 if self.penalty == "none" else 1.0 / c for c in self.strengths]
            self.betas = NT.fit(rows, F.col("block"), F.col(label), F.col(weight), "_aug", self.longest + 1, penalties,
                                self.penalty == "l1", self.max_iter)
            return self
        total = float(rows.agg(F.sum(weight)).first()[0])
        flip = F.pmod(F.xxhash64(vector_to_array("_aug"), F.col(label)), F.lit(2)) == 1
        x = self._moved(rows, F.when(flip, F.lit(-1.0)).otherwise(F.lit(1.0)))
        x = x.select("_joint", weight, F.when(flip, 1 - F.col(label)).otherwise(F.col(label)).cast("double").alias("_label"))
        reg = 0.0 if self.base is None else 1.0 / (self.base * total)
        self.model = LogisticRegression(
            featuresCol="_joint", labelCol="_label", weightCol=weight, regParam=reg,
            elasticNetParam=1.0 if self.penalty == "l1" else 0.0, standardization=False, fitIntercept=False,
            maxIter=self.max_iter, tol=self.tol).fit(x)
        return self

    def weights(self, block: int) -> Weights:
        if not self.wide:
            beta = self.betas[block]
            return Weights(DenseVector(beta[:self.sizes[block]]), float(beta[self.sizes[block]]))
        first = block * (self.longest + 1)
        own = self.model.coefficients.toArray()[first:first + self.sizes[block] + 1] * self.scales[block]
        return Weights(DenseVector(own[:-1]), float(own[-1]))

    def transform(self, rows: DataFrame) -> DataFrame:
        if not self.wide:
            return rows.withColumn("y_prob", NT.probability(self.betas, vector_to_array("_aug"), F.col("block")))
        x = self.model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("").transform(
            self._moved(rows, F.lit(1.0)))
        return x.withColumn("y_prob", vector_to_array("_p")[1]).drop("_joint", "_p")


def balanced(rows: DataFrame, keys: list[str], label: str = "escalated") -> DataFrame:
    """Weight ``w`` = n / (classes * n of the class), per ``keys``; one small row per key and class is joined back."""
    per = rows.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_c"))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys)
    per = per.select(*keys, label, (F.sum("_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("_c"))).alias("w"))
    return rows.join(F.broadcast(per), [*keys, label])      # two rows for each training set
