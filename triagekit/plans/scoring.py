"""Scored tables: out-of-fold scores with per-fold or mean F2-tuned thresholds.

The thresholds table has one row per fold (a fixed, small number), so it is
broadcast; the scored table is otherwise a narrow projection of the cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..operators import curves
from ..session import persist_shared
from ..sources.cases import cases, prepare


def with_fold_thresholds(df: DataFrame, fold: str = "fold", score: str = "y_prob",
                         label: str = "escalated", n_folds: int = C.N_FOLDS) -> DataFrame:
    """Per-fold threshold (tuned on the other folds) and decision ``y_pred``."""
    thr = curves.fold_thresholds(df, fold, score, label, n_folds).select(fold, "threshold")
    # one row per fold: size bound is n_folds
    return (df.join(F.broadcast(thr), fold)
            .withColumn("y_pred", M.apply_threshold(score, F.col("threshold"))))


def mean_threshold(df: DataFrame, fold: str = "fold", score: str = "y_prob",
                   label: str = "escalated", n_folds: int = C.N_FOLDS) -> float:
    """Mean of the per-fold thresholds (a scalar from an n_folds-row result)."""
    thr = curves.fold_thresholds(df, fold, score, label, n_folds)
    return float(thr.agg(F.avg("threshold")).first()[0])


def with_mean_threshold(df: DataFrame, mean_thresh: float, score: str = "y_prob") -> DataFrame:
    """Decision at the mean threshold."""
    return (df.withColumn("threshold", F.lit(float(mean_thresh)))
            .withColumn("y_pred", M.apply_threshold(score, mean_thresh)))


def scored_with_thresholds(spark: SparkSession, sf_dir: str):
    """(per-fold scored table, thresholds table, function that returns the mean threshold).

    The prepared cases feed both the threshold tuning and every downstream
    aggregate, so they are persisted once (memory, spilling to disk; lost
    blocks are recomputed from lineage).
    """
    base = persist_shared(prepare(cases(spark, sf_dir)))
    thr = curves.fold_thresholds(base).cache()
    scored = (base.join(F.broadcast(thr.select("fold", "threshold")), "fold")
              .withColumn("y_pred", M.apply_threshold("y_prob", F.col("threshold"))))
    return scored, thr, lambda: float(thr.agg(F.avg("threshold")).first()[0])


def scored_mean_cases(spark: SparkSession, sf_dir: str):
    """(mean-threshold scored table, mean threshold); prepared cases persisted as above."""
    base = persist_shared(prepare(cases(spark, sf_dir)))
    mt = mean_threshold(base)
    return with_mean_threshold(base, mt), mt
