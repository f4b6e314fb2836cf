"""Grouped cross-validation flows.

For each model and fold: fit the preprocessor and the estimator on the
training rows only, score validation *and* training rows, and keep a long
scored table ``(model, fold, split, row_id, label, y_prob, y_default)``.
Thresholds are tuned on the training split through the same histogram/curve
operators used everywhere else, so the train scores never leave Spark.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..operators import curves
from ..operators import features as FE
from ..operators import joint as JT
from ..operators import models as MD
from ..operators import splits as SP
from ..session import cut_lineage, persist_shared
from .parallel import parallel_map


# Rows in a partition of a fit: an iterative learner runs many short jobs, and
# smaller partitions only add scheduling to each.
FIT_ROWS = 20_000
# Partitions of a fit for each core: every task of every iteration reports to the driver.
FIT_WAVES = 8


def fit_parts(spark, n_rows: int) -> int:
    """Partitions of ``n_rows`` training rows: by rows, up to a number that the cores fix."""
    return max(1, min(-(-n_rows // FIT_ROWS), FIT_WAVES * spark.sparkContext.defaultParallelism))


def _smote_vectors(tr: DataFrame, row_id: str, label: str) -> DataFrame:
    arr = tr.select(F.col(row_id).cast("string").alias(row_id), label, vector_to_array("features").alias("vec"))
    out = SP.smote(arr, row_id, label, "vec")
    return out.select(row_id, label, array_to_vector("vec").alias("features"))


def _joint_scores(prepared: list, specs: list[MD.ModelSpec], fold: str, label: str, row_id: str, keep_train: bool,
                  hooks: dict | None, n_rows: int) -> list[DataFrame]:
    """Scores of all (fold, spec) logistic regressions; specs with one kind of penalty are one fit."""
    kinds: dict[str, list[MD.ModelSpec]] = {}
    for spec in specs:
        kinds.setdefault(spec.params.get("penalty", "l2"), []).append(spec)
    sizes = {k: JT.width(tr) for k, _, tr, _ in prepared}
    longest = max(sizes.values())
    rows = None
    for k, _, tr, va in prepared:
        for name, part in (("train", tr), ("val", va)):
            x = JT.padded(part, sizes[k], longest).select(
                F.lit(k).alias(fold), F.lit(name).alias("split"), row_id, F.col(label).cast("int").alias(label), "_aug")
            rows = x if rows is None else rows.unionByName(x)
    train = JT.balanced(rows.where("split = 'train'"), [fold], label)
    order = [k for k, *_ in prepared]
    place = F.array_position(F.array(*[F.lit(k) for k in order]), F.col(fold)).cast("int") - 1

    def fit_kind(item):
        kind, group = item
        blocks = [(k, spec) for k in order for spec in group]
        joint = JT.JointLogistic([sizes[k] for k, _ in blocks], [spec.params.get("C") or 1.0 for _, spec in blocks], kind,
                                 max(spec.params.get("max_iter", 1000) for spec in group))

        def dealt(df: DataFrame) -> DataFrame:
            each = F.explode(F.sequence(F.lit(0), F.lit(len(group) - 1)))
            return df.withColumn("_j", each).withColumn("block", place * len(group) + F.col("_j"))

        parts = fit_parts(train.sparkSession, n_rows * len(blocks))
        fit_rows = dealt(train).select("block", label, "w", "_aug").repartition(parts).cache()
        joint.fit(fit_rows, label)
        fit_rows.unpersist()
        if hooks and "model" in hooks:
            fps = {k: fp for k, fp, _, _ in prepared}
            for b, (k, spec) in enumerate(blocks):
                hooks["model"](spec, k, joint.weights(b), fps[k])
        names = F.array(*[F.lit(spec.name) for spec in group])
        scored = joint.transform(dealt(rows if keep_train else rows.where("split = 'val'")))
        return scored.select(F.element_at(names, F.col("_j") + 1).alias("model"), fold, "split", row_id, label, "y_prob",
                             (F.col("y_prob") > 0.5).cast("int").alias("y_default"))

    return parallel_map(fit_kind, list(kinds.items()))


def _boosted_models(prepared: list, specs: list[MD.ModelSpec], training_rows, label: str) -> dict:
    """Boosted models by (fold, name), all grown in one run; specs of one weighting share their training sets."""
    kinds, wanted, names = {}, [], []
    for k, _, tr, _ in prepared:
        for spec in specs:
            kinds.setdefault((k, spec.smote, spec.weighting), (tr, spec))
            wanted.append((list(kinds).index((k, spec.smote, spec.weighting)), spec))
            names.append((k, spec.name))

    def training_set(item):
        tr, spec = item
        rows = training_rows(tr, spec)
        return rows if spec.weighting else rows.withColumn("w", F.lit(1.0))

    sets = parallel_map(training_set, kinds.values())
    return dict(zip(names, MD.boosted_fits(sets, wanted, label))) if sets else {}


def cv_scores(df: DataFrame, specs: list[MD.ModelSpec], prep: FE.Preprocessor, fold: str = "fold",
              label: str = "escalated", row_id: str = "case_id", n_folds: int = C.N_FOLDS,
              keep_train: bool = True, hooks: dict | None = None) -> DataFrame:
    """Long scored table for every (model, fold, split); (fold, model) fits run concurrently.

    Class-balanced logistic regressions of all folds and penalties of a kind are one fit (``operators.joint``),
    boosted models of all folds one run (``operators.boosting``).

    Rows are scored once, into the shared checkpoint folder; everything cached
    on the way is released.
    """
    df = persist_shared(df)  # every fold reads it twice (train and validation)
    n_rows = df.count()
    parts_of_fit = fit_parts(df.sparkSession, n_rows)

    def prepare_fold(k):
        train = df.filter(F.col(fold) != k)
        val = df.filter(F.col(fold) == k)
        fp = prep.fit(train)
        tr, va = (fp.transform(x).select(F.col(row_id).cast("string").alias(row_id), label, "features")
                  .repartition(parts_of_fit).cache() for x in (train, val))
        return k, fp, tr, va

    prepared = parallel_map(prepare_fold, range(n_folds))

    def training_rows(tr: DataFrame, spec: MD.ModelSpec) -> DataFrame:
        return MD.weighted(_smote_vectors(tr, row_id, label) if spec.smote else tr, spec, label)

    boosted = _boosted_models(prepared, [s for s in specs if s.kind == "gbt"], training_rows, label)

    def fit_one(item):
        (k, fp, tr, va), spec = item
        model = boosted.get((k, spec.name))
        if model is None:
            fit_rows = training_rows(tr, spec)
            n_w = fit_rows.agg(F.sum("w")).first()[0] if spec.weighting else fit_rows.count()
            model = spec.fit(fit_rows, float(n_w), label)
        if hooks and "model" in hooks:
            hooks["model"](spec, k, model, fp)
        parts = []
        splits = [("val", va)] + ([("train", tr)] if keep_train else [])
        for name, part in splits:
            s = model.transform(part)
            if spec.kind == "linreg":
                s = s.withColumn("y_prob", F.col("prediction"))
            else:
                s = MD.positive_probability(s)
            parts.append(s.select(F.lit(spec.name).alias("model"), F.lit(k).alias(fold), F.lit(name).alias("split"),
                                  row_id, label, "y_prob", (F.col("y_prob") > 0.5).cast("int").alias("y_default")))
        return parts

    joint = [s for s in specs if s.kind == "lr" and not s.smote and s.weighting == "balanced"]
    items = [(p, spec) for p in prepared for spec in specs if spec not in joint]
    parts = [p for ps in parallel_map(fit_one, items) for p in ps]
    if joint:
        parts += _joint_scores(prepared, joint, fold, label, row_id, keep_train, hooks, n_rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = cut_lineage(out)
    for _, _, tr, va in prepared:
        tr.unpersist()
        va.unpersist()
    df.unpersist()
    return out


def cv_fold_metrics(scores: DataFrame, fold: str = "fold", label: str = "escalated") -> DataFrame:
    """Per (model, fold): tuned threshold (train split), F2 tuned/default, PR-AUC, precision, recall, counts."""
    keys = ["model", fold]
    tr = scores.filter(F.col("split") == "train")
    va = scores.filter(F.col("split") == "val")
    thr = curves.best_threshold(tr, keys, "y_prob", label)
    v = va.join(F.broadcast(thr.select(*keys, "threshold")), keys)  # one row per (model, fold)
    v = v.withColumn("y_pred", M.apply_threshold("y_prob", F.col("threshold")))
    c = v.groupBy(*keys).agg(F.first("threshold").alias("threshold"), F.count(F.lit(1)).alias("n_val"),
                             F.sum(F.col(label).cast("long")).alias("n_pos_val"),
                             *M.confusion_aggs(label, "y_pred"))
    d = va.groupBy(*keys).agg(*M.confusion_aggs(label, "y_default")).select(
        *keys, M.f2().alias("f2_default"))
    auc = curves.pr_auc(va, keys, "y_prob", label)
    out = c.select(*keys, "threshold", M.f2().alias("f2_tuned"), M.precision().alias("precision_tuned"),
                   M.recall().alias("recall_tuned"), "tn", "fp", "fn", "tp", "n_val", "n_pos_val")
    return out.join(d, keys).join(auc, keys)


def model_summary(fm: DataFrame, scores: DataFrame, label: str = "escalated") -> DataFrame:
    """Per model: mean and sample std of fold metrics, pooled F2 (default and tuned), rank."""
    g = fm.groupBy("model").agg(
        F.avg("f2_default").alias("mean_f2_default"), F.stddev_samp("f2_default").alias("std_f2_default"),
        F.avg("f2_tuned").alias("mean_f2_tuned"), F.stddev_samp("f2_tuned").alias("std_f2_tuned"),
        F.avg("pr_auc").alias("mean_pr_auc"), F.stddev_samp("pr_auc").alias("std_pr_auc"),
        F.avg("threshold").alias("mean_threshold"), F.avg("precision_tuned").alias("mean_precision"),
        F.avg("recall_tuned").alias("mean_recall"),
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    g = g.withColumn("overall_f2_tuned", M.f2())
    va = scores.filter(F.col("split") == "val")
    pooled_d = va.groupBy("model").agg(*M.confusion_aggs(label, "y_default")).select("model", M.f2().alias("overall_f2_default"))
    g = g.drop("tp", "fp", "fn").join(pooled_d, "model")
    return g.withColumn("summary_f2", M.mean_std_text("mean_f2_tuned", "std_f2_tuned")).withColumn(
        "summary_pr_auc", M.mean_std_text("mean_pr_auc", "std_pr_auc"))


def rank_models(summary: DataFrame, metric: str = "mean_f2_tuned") -> DataFrame:
    """Rank by metric (desc), ties by model name (F5); rank 1 is the selection."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col(metric).desc(), F.col("model"))  # one row per model
    return summary.withColumn("rank", F.row_number().over(w)).withColumn("selected", F.col("rank") == 1)


def oof_scored(df: DataFrame, spec: MD.ModelSpec, prep: FE.Preprocessor, fold: str = "fold",
               label: str = "escalated", row_id: str = "case_id", mode: str = "per_fold",
               hooks: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(out-of-fold scored rows, fold metrics) of one fitted model.

    Each row's score comes from the fold that held it out; ``threshold`` and
    ``y_pred`` are the fold's tuned ones, or with ``mode='mean'`` those of the
    folds' mean threshold.
    """
    s = cv_scores(df, [spec], prep, fold, label, row_id, hooks=hooks)
    fm = cut_lineage(cv_fold_metrics(s, fold, label))   # one row per fold
    va = s.filter(F.col("split") == "val").drop("split", "y_default")
    if mode == "per_fold":
        va = va.join(F.broadcast(fm.select("model", fold, "threshold")), ["model", fold])
    else:
        mt = float(fm.agg(F.avg("threshold")).first()[0])
        va = va.withColumn("threshold", F.lit(mt))
    return va.withColumn("y_pred", M.apply_threshold("y_prob", F.col("threshold"))), fm


def with_case_columns(scored: DataFrame, cases: DataFrame, row_id: str = "case_id") -> DataFrame:
    """Scatter out-of-fold scores back to case rows by key."""
    c = cases.select(F.col(row_id).cast("string").alias(row_id), *[x for x in cases.columns
                                                                    if x not in (row_id, "escalated", "y_prob", "fold")])
    return scored.join(c, row_id)
