"""Local surrogate of a scorer around single rows (M3): weighted linear fits on perturbed copies of each row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

DRAWS = 5000  # perturbed copies of an explained row
BLOCK = 250  # copies drawn, and summed into one partial matrix, at a time
KERNEL = 0.75  # kernel width in units of sqrt(number of features)


def spread(train: DataFrame, features: str = "features") -> list[float]:
    """Standard deviation of every feature over the training rows (one aggregate)."""
    return [float(v) for v in train.agg(Summarizer.std(F.col(features))).first()[0]]


def perturbed(rows: DataFrame, row_id: str, scale: list[float], features: str = "features", draws: int = DRAWS,
              seed: int = C.SEED) -> DataFrame:
    """``draws`` copies of each row, every feature moved by normal noise of its own spread: id, block, noise, features.

    The noise of a block is seeded by the row id and the block number, so a
    recomputed task draws the same copies. A feature without spread stays.
    """
    sd = np.asarray(scale)

    def draw(batches):
        for b in batches:
            for case, block, n, state, x in zip(b["_id"], b["_block"], b["_n"], b["_state"], b["_x"]):
                eps = np.random.default_rng([seed, state & 0xFFFFFFFFFFFFFFFF, block]).normal(size=(n, len(sd)))
                yield pd.DataFrame({"_id": [case] * n, "_block": block, "_eps": list(eps), "_x": list(np.asarray(x) + eps * sd)})

    last = -(-draws // BLOCK) - 1
    blocks = rows.select(F.col(row_id).alias("_id"), vector_to_array(features).alias("_x"),
                         F.xxhash64(F.col(row_id).cast("string")).alias("_state"),
                         F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_block"))
    blocks = blocks.withColumn("_n", F.when(F.col("_block") == last, draws - last * BLOCK).otherwise(BLOCK))
    id_type = rows.schema[row_id].dataType.simpleString()
    out = blocks.repartition("_id", "_block").mapInPandas(draw, f"_id {id_type}, _block int, _eps array<double>, _x array<double>")
    return out.withColumn(features, array_to_vector("_x")).drop("_x")


def local_weights(rows: DataFrame, row_id: str, names: list[str], scale: list[float], score: Callable[[DataFrame], DataFrame],
                  features: str = "features", k: int = C.TOP_FEATURES, draws: int = DRAWS, seed: int = C.SEED) -> DataFrame:
    """Per row the ``k`` features of largest local effect: id, rank, feature, weight, effect.

    ``score`` adds the column ``_y`` to a frame with ``features``. The scores
    of the copies are fitted by weighted least squares on the features' moves;
    near copies weigh more. ``weight`` is the score's change per unit of a
    feature (a linear scorer's coefficient), ``effect`` per standard
    deviation, which ranks; ties go to the name. Each block of copies gives one
    partial normal matrix, and a row's partial matrices are summed in one group
    of ``draws / BLOCK`` entries. Features without spread have weight 0.
    """
    d = len(names)
    if draws <= d:
        raise ValueError(f"{draws} copies cannot fit {d} features")
    sd = np.asarray(scale)
    width2 = KERNEL ** 2 * d
    id_type = rows.schema[row_id].dataType.simpleString()

    def partial(key, block):
        eps = np.stack(block["_eps"].to_numpy())
        x = np.column_stack([np.ones(len(eps)), eps])
        w = np.exp(-0.5 * (eps ** 2).sum(axis=1) / width2)
        xw = x * w[:, None]
        return pd.DataFrame({"_id": [key[0]], "_a": [(xw.T @ x).ravel()], "_b": [xw.T @ block["_y"].to_numpy()]})

    def solve(key, parts):
        a = np.sum(parts["_a"].to_list(), axis=0).reshape(d + 1, d + 1)
        effect = np.linalg.solve(a, np.sum(parts["_b"].to_list(), axis=0))[1:]
        effect[sd == 0] = 0.0
        order = sorted(range(d), key=lambda j: (-abs(effect[j]), names[j]))[:k]
        weight = np.divide(effect, sd, out=np.zeros(d), where=sd > 0)
        return pd.DataFrame({"_id": [key[0]] * len(order), "rank": np.arange(1, len(order) + 1, dtype=np.int32),
                             "feature": [names[j] for j in order], "weight": weight[order], "effect": effect[order]})

    scored = score(perturbed(rows, row_id, scale, features, draws, seed)).select("_id", "_block", "_eps", "_y")
    sums = scored.groupBy("_id", "_block").applyInPandas(partial, f"_id {id_type}, _a array<double>, _b array<double>")
    out = sums.groupBy("_id").applyInPandas(solve, f"_id {id_type}, rank int, feature string, weight double, effect double")
    return out.withColumnRenamed("_id", row_id)
