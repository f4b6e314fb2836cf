"""Classifier and unsupervised model stages on assembled feature vectors.

Thin, explicit configurations of ``pyspark.ml`` estimators that reproduce the
reference objectives where the libraries differ (class-balanced weights,
C -> regParam, population-scaled inputs), plus a few evaluation helpers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import boosting as BO
from . import newton as NT


def balanced_weights(df: DataFrame, label: str = "escalated", out: str = "w") -> DataFrame:
    """n / (2 * n_class) per row, so the weights sum to n (class_weight='balanced')."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # two classes
    n = sum(counts.values())
    expr = None
    for cls, c in counts.items():
        w = n / (len(counts) * c)
        expr = F.when(F.col(label) == cls, F.lit(w)) if expr is None else expr.when(F.col(label) == cls, F.lit(w))
    return df.withColumn(out, expr if expr is not None else F.lit(1.0))


def pos_weight(df: DataFrame, label: str = "escalated", out: str = "w") -> DataFrame:
    """Positive rows weighted by n_neg / n_pos (scale_pos_weight), negatives 1."""
    r = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).first()
    spw = (r["q"] / r["p"]) if r["p"] else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


# Memory for the split statistics of tree learners, in MB: one fixed value, since a
# binding limit changes the order of nodes and with it the random feature draws.
TREE_MEMORY_MB = 512

_LEAF = re.compile(r"Predict: (\S+)")


@dataclass
class ModelSpec:
    """A named classifier configuration."""
    name: str
    kind: str  # 'lr' | 'rf' | 'gbt' | 'linreg'
    params: dict = field(default_factory=dict)
    weighting: str | None = "balanced"  # 'balanced' | 'pos' | None
    smote: bool = False

    def estimator(self, n_weight_sum: float, label: str = "escalated", features: str = "features"):
        p = dict(self.params)
        wcol = "w" if self.weighting else None
        if self.kind == "lr":
            penalty = p.pop("penalty", "l2")
            c = p.pop("C", 1.0)
            if penalty == "none" or c is None:
                reg, en = 0.0, 0.0
            else:
                reg = 1.0 / (c * n_weight_sum)
                en = 1.0 if penalty == "l1" else 0.0
            est = LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=en,
                                     standardization=False, maxIter=p.pop("max_iter", 1000), tol=1e-6)
        elif self.kind == "rf":
            est = RandomForestClassifier(featuresCol=features, labelCol=label,
                                         numTrees=p.pop("n_estimators", 300), maxDepth=p.pop("max_depth", 15),
                                         minInstancesPerNode=p.pop("min_samples_leaf", 5), seed=C.SEED,
                                         maxMemoryInMB=TREE_MEMORY_MB, cacheNodeIds=True)
        elif self.kind == "gbt":
            est = GBTClassifier(featuresCol=features, labelCol=label, maxIter=p.pop("n_estimators", 300),
                                maxDepth=p.pop("max_depth", 5), stepSize=p.pop("learning_rate", 0.1), seed=C.SEED,
                                maxMemoryInMB=TREE_MEMORY_MB, cacheNodeIds=True)
        elif self.kind == "linreg":
            est = LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, standardization=False)
        else:
            raise ValueError(self.kind)
        if wcol and hasattr(est, "setWeightCol"):
            est = est.setWeightCol(wcol)
        return est

    def fit(self, rows: DataFrame, n_weight_sum: float, label: str = "escalated", features: str = "features"):
        """Fitted scorer; logistic regression penalises its intercept as liblinear does."""
        est = self.estimator(n_weight_sum, label, features)
        if self.kind == "lr":
            return InterceptPenalisedLR.fit(est, rows, label, features)
        return est.fit(rows)


class InterceptPenalisedLR:
    """Logistic regression whose intercept is penalised like the other weights (liblinear's objective).

    A constant 1 is appended to the features, so that its weight is an
    intercept inside the penalty. Fitted by Newton's method (``operators.newton``);
    features wider than it holds go to MLlib's solver, with the vector of a
    hash-chosen half of the rows negated and their labels flipped: the loss of
    a row is unchanged, and the constant varies.
    """

    def __init__(self, weights, model=None):
        self.model = model      # MLlib's, for wide features only
        self._coef, self._b = np.asarray(weights[:-1]), float(weights[-1])

    @property
    def coefficients(self):
        from pyspark.ml.linalg import DenseVector
        return DenseVector(self._coef)

    @property
    def intercept(self) -> float:
        return self._b

    @staticmethod
    def augment(df: DataFrame, features: str = "features", out: str = "_aug") -> DataFrame:
        arr = F.concat(vector_to_array(features), F.array(F.lit(1.0)))
        return df.withColumn(out, array_to_vector(arr))

    @classmethod
    def fit(cls, est: LogisticRegression, df: DataFrame, label: str, features: str = "features"):
        from ..session import persist_shared
        from .joint import width
        size = width(df, features) + 1
        if size > NT.MOST_FEATURES:
            return cls._fit_wide(est, df, label, features)
        weight = F.col(est.getWeightCol()) if est.isSet("weightCol") else F.lit(1.0)
        rows = persist_shared(df.select(F.col(label).alias("_y"), weight.cast("double").alias("_w"), features))
        total = float(rows.agg(F.sum("_w")).first()[0])
        beta = NT.fit(cls.augment(rows, features), F.lit(0), F.col("_y"), F.col("_w"), "_aug", size,
                      [est.getRegParam() * total], est.getElasticNetParam() == 1.0, est.getMaxIter())[0]
        rows.unpersist()
        return cls(beta)

    @classmethod
    def _fit_wide(cls, est: LogisticRegression, df: DataFrame, label: str, features: str):
        arr = F.concat(vector_to_array(features), F.array(F.lit(1.0)))
        flip = F.pmod(F.xxhash64(vector_to_array(features), F.col(label)), F.lit(2)) == 1
        x = df.withColumn("_aug", array_to_vector(F.when(flip, F.transform(arr, lambda v: -v)).otherwise(arr))) \
              .withColumn("_lab", F.when(flip, F.lit(1) - F.col(label)).otherwise(F.col(label)).cast("double"))
        m = est.copy().setFeaturesCol("_aug").setLabelCol("_lab").setFitIntercept(False).fit(x)
        return cls(m.coefficients.toArray(), m)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds ``probability`` (of labels 0 and 1) and ``prediction``."""
        if self.model is not None:
            return self.model.transform(self.augment(df, features)).drop("_aug")
        arr = F.concat(vector_to_array(features), F.array(F.lit(1.0)))
        p = NT.probability([np.append(self._coef, self._b)], arr, F.lit(0))
        return (df.withColumn("_p1", p).withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p1"), "_p1")))
                .withColumn("prediction", (F.col("_p1") > 0.5).cast("double")).drop("_p1"))


def reference_models() -> list[ModelSpec]:
    """The five compared configurations (K1-K5)."""
    return [
        ModelSpec("LR_baseline", "lr", {"penalty": "l2", "C": 1.0}, "balanced"),
        ModelSpec("RF", "rf", {"n_estimators": 300, "max_depth": 15, "min_samples_leaf": 5}, "balanced"),
        ModelSpec("XGB", "gbt", {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.1}, "pos"),
        ModelSpec("LR_SMOTE", "lr", {"penalty": "l2", "C": 1.0}, None, smote=True),
        ModelSpec("XGB_SMOTE", "gbt", {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.1}, None, smote=True),
    ]


def regularisation_models() -> list[ModelSpec]:
    """L2 C=1/0.1/10, L1 C=1/0.1, unregularised (K7)."""
    names = {("l2", 1.0): "LR_L2_C1.0", ("l2", 0.1): "LR_L2_C0.1", ("l2", 10.0): "LR_L2_C10",
             ("l1", 1.0): "LR_L1_C1.0", ("l1", 0.1): "LR_L1_C0.1", ("none", None): "LR_none"}
    return [ModelSpec(names[(p, c)], "lr", {"penalty": p, "C": c, "max_iter": 2000}, "balanced") for p, c in C.REG_GRID]


def weighted(df: DataFrame, spec: ModelSpec, label: str = "escalated") -> DataFrame:
    if spec.weighting == "balanced":
        return balanced_weights(df, label)
    if spec.weighting == "pos":
        return pos_weight(df, label)
    return df


def boosted_fits(sets: list[DataFrame], wanted: list[tuple[int, ModelSpec]], label: str = "escalated") -> list[BO.Boosted]:
    """Boosted models of all (training set, spec) pairs, grown together (``operators.boosting``); sets have a weight ``w``."""
    fits = []
    for g, spec in wanted:
        est = spec.estimator(1.0, label)
        fits.append(BO.Fit(g, est.getMaxDepth(), est.getStepSize(), est.getMaxIter()))
    return BO.fit(sets, fits, label)


def leaf_terms(model) -> list:
    """Per tree of a boosted model, tree weight times prediction of each leaf, in the order ``leafCol`` numbers them."""
    out = []
    for tree, weight in zip(model.trees, model.treeWeights):
        values = [float(v) for v in _LEAF.findall(tree.toDebugString)]
        if len(values) != (tree.numNodes + 1) // 2:
            raise ValueError(f"{len(values)} leaves read of a tree of {tree.numNodes} nodes")
        out.append([weight * v for v in values])
    return out


def staged_scores(model, df: DataFrame, rounds: list[int], keep: list[str], features: str = "features") -> DataFrame:
    """Scores of a fitted boosted model after each number of ``rounds``: ``keep``, n_estimators, margin, y_prob.

    Boosting without row subsampling is sequential and deterministic, so the
    first n rounds equal a model fitted with ``maxIter=n``: a grid over round
    counts needs one fit at the largest. Each row meets the trees once (the
    model's leaf column); a running sum over the leaf terms is read at every
    wanted count. The table of terms has at most 2^depth numbers a tree.
    """
    if max(rounds) > model.getNumTrees or min(rounds) < 1:
        raise ValueError(f"the model has {model.getNumTrees} rounds, asked for {rounds}")
    if isinstance(model, BO.Boosted):
        return _staged(df.select(*keep, model.margin_column(features, rounds).alias("_m")), rounds, keep)
    terms = leaf_terms(model)
    table = np.zeros((len(terms), max(map(len, terms))))
    for i, t in enumerate(terms):
        table[i, :len(t)] = t
    at = [n - 1 for n in rounds]

    @F.pandas_udf("array<double>")
    def margins(leaves: pd.Series) -> pd.Series:
        if leaves.empty:
            return pd.Series([], dtype=object)
        leaf = np.stack(leaves.to_numpy()).astype(np.int64)
        running = np.cumsum(table[np.arange(len(table)), leaf], axis=1)
        return pd.Series(list(running[:, at]))

    plain = model.copy().setFeaturesCol(features).setLeafCol("_leaves")
    for clear in (plain.setPredictionCol, plain.setRawPredictionCol, plain.setProbabilityCol):
        clear("")
    return _staged(plain.transform(df).select(*keep, margins(vector_to_array("_leaves")).alias("_m")), rounds, keep)


def grid_scores(models: dict[tuple, BO.Boosted], names: list[str], df: DataFrame, rounds: list[int], keep: list[str],
                features: str = "features") -> DataFrame:
    """``staged_scores`` of several boosted models in one pass: ``keep``, the parts of a model's key as ``names``,
    n_estimators, y_prob."""
    fitted = list(models.values())
    if max(rounds) > min(m.getNumTrees for m in fitted) or min(rounds) < 1:
        raise ValueError(f"a model has fewer rounds than asked for: {rounds}")

    @F.pandas_udf("array<double>")
    def score(x: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype=object)
        rows = np.stack(x.to_numpy())
        return pd.Series(list(np.concatenate([m.margins(rows, rounds) for m in fitted], axis=1)))

    places = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, key)], F.lit(int(r)).alias("n_estimators"))
                       for key in models for r in rounds])
    m = df.select(*keep, F.inline(F.arrays_zip(places.alias("p"), score(vector_to_array(features)).alias("m"))).alias("p", "_m"))
    return m.select(*keep, "p.*", (1.0 / (1.0 + F.exp(-2.0 * F.col("_m")))).alias("y_prob"))


def _staged(m: DataFrame, rounds: list[int], keep: list[str]) -> DataFrame:
    """A row for every number of rounds of the margins ``_m``."""
    pairs = F.arrays_zip(F.array(*[F.lit(int(n)) for n in rounds]).alias("n"), F.col("_m").alias("m"))
    s = m.select(*keep, F.inline(pairs).alias("n_estimators", "margin"))
    return s.withColumn("y_prob", 1.0 / (1.0 + F.exp(-2.0 * F.col("margin"))))


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "y_prob") -> DataFrame:
    return df.withColumn(out, vector_to_array(prob_col).getItem(1))


def nonzero_coefficients(model, eps: float = 1e-6) -> int:
    return int(sum(1 for v in model.coefficients.toArray() if abs(v) > eps))


# ------------------------------------------------------------------------- unsupervised

def pca_fit(df: DataFrame, k: int, features: str = "features"):
    """Centre (no scaling), then PCA; returns (scaler model, pca model)."""
    sc = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df)
    pca = PCA(k=k, inputCol="_centred", outputCol="pcs").fit(sc.transform(df))
    return sc, pca


def pca_transform(df: DataFrame, sc, pca) -> DataFrame:
    return pca.transform(sc.transform(df)).drop("_centred")


# Rows of a packed block of points.
KMEANS_ROWS = 4096


@dataclass
class Centres:
    """A fitted K-Means: ``transform`` adds the nearest centre, the first of equals, as ``cluster``."""
    centres: np.ndarray
    features: str

    def transform(self, df: DataFrame) -> DataFrame:
        c = self.centres

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            if x.empty:
                return pd.Series([], dtype="int32")
            return pd.Series(((c * c).sum(axis=1) - 2.0 * (np.stack(x.to_numpy()) @ c.T)).argmin(axis=1).astype("int32"))

        return df.withColumn("cluster", nearest(vector_to_array(self.features)))


def lloyd(df: DataFrame, features: str, starts: list[np.ndarray], max_iter: int, tol: float) -> list[tuple[np.ndarray, float]]:
    """Lloyd's iterations of many sets of centres at once, one job an iteration: per set the centres and the training cost.

    The rules are MLlib's: a set ends when no centre moves farther than ``tol``,
    a centre without points stays, and the cost is that of the last assignment.
    A task returns sums as large as all the centres; there are two tasks a core.
    """
    from ..session import persist_shared
    d = starts[0].shape[1]

    def pack(batches):
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield pa.RecordBatch.from_pydict({"x": pa.array([x[i:i + KMEANS_ROWS].tobytes() for i in range(0, len(x), KMEANS_ROWS)],
                                                            pa.binary())})

    points = persist_shared(df.select(vector_to_array(features).alias("x")).mapInArrow(pack, "x binary")
                            .coalesce(2 * df.sparkSession.sparkContext.defaultParallelism))
    now, cost, active = [c.copy() for c in starts], [0.0] * len(starts), list(range(len(starts)))
    for _ in range(max_iter):
        if not active:
            break
        centres = np.concatenate([now[i] for i in active])
        cuts = np.cumsum([0] + [len(now[i]) for i in active])

        def sums(batches, centres=centres, cuts=cuts):
            square, out = (centres * centres).sum(axis=1), np.zeros((len(centres), d + 2))
            for b in batches:
                for v in b.column(0):
                    x = np.frombuffer(v.as_py()).reshape(-1, d)
                    far, every = square - 2.0 * (x @ centres.T), np.arange(len(x))
                    own = (x * x).sum(axis=1)
                    member = np.zeros((len(x), len(centres)))
                    for lo, hi in zip(cuts[:-1], cuts[1:]):
                        at = far[:, lo:hi].argmin(axis=1) + lo
                        member[every, at] = 1.0
                        out[lo, d + 1] += np.maximum(far[every, at] + own, 0.0).sum()
                    out[:, :d] += member.T @ x
                    out[:, d] += member.sum(axis=0)
            yield pa.RecordBatch.from_pydict({"s": pa.array([out.tobytes()], pa.binary())})

        total = np.sum([np.frombuffer(r["s"]).reshape(-1, d + 2) for r in points.mapInArrow(sums, "s binary").collect()], axis=0)
        left = []
        for i, lo, hi in zip(active, cuts[:-1], cuts[1:]):
            part = total[lo:hi]
            full = part[:, d] > 0
            new = now[i].copy()
            new[full] = part[full, :d] / part[full, d:d + 1]
            moved = ((new - now[i]) ** 2).sum(axis=1).max()
            now[i], cost[i] = new, float(part[0, d + 1])
            if moved > tol * tol:
                left.append(i)
        active = left
    points.unpersist()
    return list(zip(now, cost))


def kmeans_best(df: DataFrame, ks: list[int], features: str = "pcs", restarts: int = 10) -> dict[int, tuple[Centres, float]]:
    """K-Means for each k with ``restarts`` seeds, keeping the lowest training cost: per k the model and its cost.

    MLlib draws the first centres of every seed; the iterations of all seeds and k are one run.
    """
    from ..plans.parallel import parallel_map
    items = [(k, s) for k in ks for s in range(restarts)]

    def start(item) -> np.ndarray:
        k, s = item
        first = KMeans(k=k, featuresCol=features, predictionCol="cluster", seed=C.SEED + s, maxIter=0).fit(df)
        return np.array(first.clusterCenters())

    fits = lloyd(df, features, parallel_map(start, items), 300, 1e-4)
    best = {}
    for (k, _), (centres, cost) in zip(items, fits):
        if k not in best or cost < best[k][1]:
            best[k] = Centres(centres, features), cost
    return best


class F2Evaluator:
    """F2 of a scored frame at a fixed or F2-tuned threshold (O2), usable like an ``Evaluator``."""

    def __init__(self, label: str = "escalated", score: str = "y_prob", threshold: float | None = None):
        self.label, self.score, self.threshold = label, score, threshold

    def evaluate(self, df: DataFrame) -> float:
        from . import curves
        from ..functions import metrics as M
        t = self.threshold
        if t is None:
            t = float(curves.best_threshold(df, [], self.score, self.label).first()["threshold"])
        pred = df.withColumn("_p", M.apply_threshold(self.score, t))
        return float(pred.agg(*M.confusion_aggs(self.label, "_p")).select(M.f2()).first()[0])

    def isLargerBetter(self) -> bool:  # noqa: N802 - mirrors the Evaluator API
        return True
