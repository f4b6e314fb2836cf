"""Logistic regressions by Newton's method.

An L-BFGS fit of unscaled text features takes hundreds of steps, each one Spark
job over all rows. A Newton step needs the same pass and also the second
derivatives, a matrix as wide as the features, and ten to twenty steps end at
the exact optimum. Every step is one job for all blocks (training sets): tasks
sum the matrices of their rows, strips of them are summed by key, and the driver
solves one system of the features' width for each block.

Objective of a block: sum of weight * logistic loss, plus its penalty times half
the squared norm of the weights or, under L1, their absolute sum. Under L1 the
quadratic model of a step is minimised by coordinate descent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Widest features: a task and the driver hold matrices of this width squared.
MOST_FEATURES = 4096
# Rows of a matrix summed under one key, and rows of the table multiplied at a time.
STRIP, CHUNK = 64, 1024
# A block ends when a step can gain less than this share of its first loss.
GAIN = 1e-10
_SUMS = "block int, strip int, m binary"


def _sums(rows: DataFrame, betas: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per block the matrix of second derivatives, bordered by the gradient and, in the corner, the loss."""
    d = len(next(iter(betas.values())))

    def partial(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            if any(b.column(c).null_count for c in ("block", "y", "w", "x")):
                raise ValueError("a training row lacks its label, weight or features")
            block, y, w = (b.column(c).to_numpy(zero_copy_only=False) for c in ("block", "y", "w"))
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(block), d)
            for k in np.unique(block):
                at = np.flatnonzero(block == k)
                m = acc.setdefault(int(k), np.zeros((d + 1, d + 1)))
                for i in range(0, len(at), CHUNK):
                    c = at[i:i + CHUNK]
                    xc, yc, wc = x[c], y[c], w[c]
                    z = xc @ betas[int(k)]
                    p = 0.5 * (1.0 + np.tanh(0.5 * z))
                    m[:d, :d] += (xc * (wc * p * (1.0 - p))[:, None]).T @ xc
                    m[:d, d] += xc.T @ (wc * (p - yc))
                    m[d, d] += float(wc @ (np.logaddexp(0.0, z) - yc * z))
        for k, m in acc.items():
            for s in range(0, d + 1, STRIP):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "strip": pa.array([s], pa.int32()),
                                                  "m": pa.array([m[s:s + STRIP].tobytes()], pa.binary())})

    def added(key, strips):
        total = np.sum([np.frombuffer(v) for v in strips["m"]], axis=0)
        return pd.DataFrame({"block": [key[0]], "strip": [key[1]], "m": [total.tobytes()]})

    strips = len(betas) * (d // STRIP + 1)
    parts = min(strips, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    got = (rows.where(F.col("block").isin([int(k) for k in betas])).mapInArrow(partial, _SUMS)
           .repartition(parts, "block", "strip").groupBy("block", "strip").applyInPandas(added, _SUMS).collect())
    out = {k: np.zeros((d + 1, d + 1)) for k in betas}
    for r in got:
        m = np.frombuffer(r["m"]).reshape(-1, d + 1)
        out[r["block"]][r["strip"]:r["strip"] + len(m)] = m
    return out


def _descent(h: np.ndarray, g: np.ndarray, beta: np.ndarray, penalty: float, sweeps: int = 2000) -> np.ndarray:
    """Weights that minimise the quadratic model around ``beta`` with an L1 penalty."""
    new, r, diag = beta.copy(), g.copy(), np.diag(h)
    live = np.flatnonzero(diag > 0)
    new[diag <= 0] = 0.0
    full = True
    for _ in range(sweeps):
        most = 0.0
        for j in (live if full else live[new[live] != 0]):
            a = diag[j] * new[j] - r[j]
            to = np.sign(a) * max(abs(a) - penalty, 0.0) / diag[j]
            move = to - new[j]
            if move:
                new[j] = to
                r += h[j] * move
                most = max(most, abs(move) * np.sqrt(diag[j]))
        if most < 1e-9:
            if full:
                break
            full = True
        else:
            full = False
    return new


@dataclass
class _Block:
    """Search of one block: the last accepted weights, the step from them and the share of it that is tried."""
    beta: np.ndarray
    value: float = np.inf
    first: float | None = None
    step: np.ndarray | None = None
    share: float = 1.0
    done: bool = False

    def trial(self) -> np.ndarray:
        return self.beta if self.step is None else self.beta + self.share * self.step

    def take(self, m: np.ndarray, penalty: float, l1: bool) -> None:
        """Accept or shorten the step tried, from the sums at ``trial()``."""
        d = len(self.beta)
        beta, h, g = self.trial(), m[:d, :d], m[:d, d]
        size = np.abs(beta).sum() if l1 else 0.5 * float(beta @ beta)
        value = float(m[d, d]) + penalty * size
        if not np.isfinite(value):
            raise ValueError("the loss is not finite: a label, weight or feature is not")
        self.first = value if self.first is None else self.first
        if value > self.value * (1.0 + 1e-13):
            self.share /= 2.0
            self.done = self.share < 1e-6
            return
        self.beta, self.value, self.share = beta, value, 1.0
        h = h + np.eye(d) * (1e-12 * max(float(np.diag(h).max()), 1e-300))
        if l1:
            self.step = _descent(h, g, beta, penalty) - beta
            gain = -(g @ self.step + 0.5 * self.step @ h @ self.step + penalty * (np.abs(beta + self.step).sum() - size))
        else:
            g = g + penalty * beta
            self.step = -np.linalg.solve(h + penalty * np.eye(d), g)
            gain = -0.5 * float(g @ self.step)
        self.done = not gain > GAIN * max(self.first, 1e-300)
        if self.done and np.isfinite(self.step).all() and gain >= 0:
            self.beta = self.beta + self.step


def fit(rows: DataFrame, block: Column, label: Column, weight: Column, features: str, width: int, penalties: list[float],
        l1: bool = False, max_iter: int = 1000) -> list[np.ndarray]:
    """Weights of every block; ``features`` is a vector column of ``width`` places, ``penalties`` has one value a block."""
    x = rows.select(block.cast("int").alias("block"), label.cast("double").alias("y"), weight.cast("double").alias("w"),
                    vector_to_array(features).alias("x"))
    blocks = [_Block(np.zeros(width)) for _ in penalties]
    for _ in range(max_iter):
        active = {k: b.trial() for k, b in enumerate(blocks) if not b.done}
        if not active:
            break
        for k, m in _sums(x, active).items():
            blocks[k].take(m, penalties[k], l1)
    return [b.beta for b in blocks]


def probability(betas: list[np.ndarray], features: Column, block: Column) -> Column:
    """Probability of label 1 for arrays of features with a constant behind them."""
    table = np.stack(betas)

    @F.pandas_udf("double")
    def score(x: pd.Series, k: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype="float64")
        z = np.einsum("ij,ij->i", np.stack(x.to_numpy()), table[k.to_numpy()])
        return pd.Series(0.5 * (1.0 + np.tanh(0.5 * z)))

    return score(features, block)
