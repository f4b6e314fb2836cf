"""Model studies built on the grouped CV flow.

Each study returns a small result table (one row per configuration / fold /
component); row-level work stays in Spark jobs, and only model metadata
(coefficients, explained variance, cluster costs) is read on the driver.
"""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import metrics as M
from ..operators import curves
from ..operators import features as FE
from ..operators import interpret as IN
from ..operators import models as MD
from ..operators import splits as SP
from ..operators import stats as ST
from ..operators import surrogate as SU
from ..session import cut_lineage, persist_shared
from . import cv


def _fold_f2_table(fm: DataFrame, name_col: str = "model") -> DataFrame:
    return fm.groupBy(name_col).agg(F.avg("f2_tuned").alias("f2_mean"), F.stddev_pop("f2_tuned").alias("f2_std"),
                                    F.avg("pr_auc").alias("pr_auc_mean"), F.avg("recall_tuned").alias("recall"),
                                    F.avg("precision_tuned").alias("precision"))


def paired_vs_baseline(fm: DataFrame, baseline: str, name_col: str = "model", metric: str = "f2_tuned",
                       fold: str = "fold") -> DataFrame:
    """Per config: mean fold difference to the baseline, paired t and two-sided p."""
    b = fm.filter(F.col(name_col) == baseline).select(fold, F.col(metric).alias("_b"))
    d = fm.filter(F.col(name_col) != baseline).join(b, fold).select(name_col, (F.col(metric) - F.col("_b")).alias("d"))
    g = d.groupBy(name_col).agg(F.count(F.lit(1)).alias("_n"), F.avg("d").alias("mean_diff_vs_baseline"),
                                F.stddev_samp("d").alias("_sd"))
    g = g.withColumn("t_vs_baseline", F.col("mean_diff_vs_baseline") / (F.col("_sd") / F.sqrt("_n")))
    spark = fm.sparkSession
    rows = g.select(name_col, "t_vs_baseline", "_n").collect()  # one row per config
    ps = [(r[name_col], 2.0 * ST.t_sf(spark, abs(r["t_vs_baseline"]), r["_n"] - 1)
           if r["t_vs_baseline"] is not None and r["t_vs_baseline"] == r["t_vs_baseline"] else None) for r in rows]
    pt = spark.createDataFrame(ps, f"{name_col} string, p_vs_baseline double")
    return g.drop("_n", "_sd").join(pt, name_col)


def lr_cv(df: DataFrame, prep: FE.Preprocessor, **kw) -> DataFrame:
    """Baseline LR fold table (L1): fold, F2 (tuned and default), PR-AUC, precision, recall, counts."""
    s = cv.cv_scores(df, [MD.reference_models()[0]], prep, **kw)
    return cv.cv_fold_metrics(s)


def compare_models(df: DataFrame, prep: FE.Preprocessor, specs: list[MD.ModelSpec]) -> DataFrame:
    """Model comparison with ranking and selection."""
    s = cv.cv_scores(df, specs, prep)
    fm = cv.cv_fold_metrics(s).cache()
    ranked = cv.rank_models(cv.model_summary(fm, s))
    base = specs[0].name
    return ranked.join(paired_vs_baseline(fm, base), "model", "left")


def regularisation_study(df: DataFrame, prep: FE.Preprocessor) -> DataFrame:
    """F2 mean / population std and mean non-zero coefficients per LR penalty config (K7)."""
    nz = []
    hooks = {"model": lambda spec, k, model, fp: nz.append((spec.name, k, MD.nonzero_coefficients(model)))}
    s = cv.cv_scores(df, MD.regularisation_models(), prep, hooks=hooks)
    t = _fold_f2_table(cv.cv_fold_metrics(s))
    spark = df.sparkSession
    z = spark.createDataFrame(nz, "model string, fold int, nonzero int").groupBy("model").agg(
        F.avg("nonzero").alias("avg_nonzero_features"))
    return t.join(z, "model").withColumnRenamed("model", "config")


def ols_baseline(df: DataFrame, prep: FE.Preprocessor) -> DataFrame:
    """Linear regression on the 0/1 target per fold: F2 at 0.5, MSE, R^2, predictions outside [0, 1]."""
    s = cv.cv_scores(df, [MD.ModelSpec("OLS", "linreg", {}, None)], prep, keep_train=False)
    v = s.withColumn("y_bin", (F.col("y_prob") >= 0.5).cast("int"))
    y, p = F.col("escalated").cast("double"), F.col("y_prob")
    g = v.groupBy("fold").agg(*M.confusion_aggs("escalated", "y_bin"), F.avg((y - p) * (y - p)).alias("mse"),
                              F.var_pop(y).alias("_vy"), F.count_if(p < 0).alias("preds_below_0"),
                              F.count_if(p > 1).alias("preds_above_1"))
    return g.select("fold", M.f2().alias("f2"), "mse",
                    F.when(F.col("_vy") > 0, 1 - F.col("mse") / F.col("_vy")).alias("r2"), "preds_below_0", "preds_above_1")


def grid_search(df: DataFrame, prep: FE.Preprocessor, grid: dict = C.GBT_GRID, label: str = "escalated") -> DataFrame:
    """Boosted-tree grid: mean / sample std of tuned F2 per config, ranked (L3, L4).

    One fit per (depth, learning rate) at the largest round count per fold, all
    of them grown in one run (``operators.boosting``); smaller round counts are
    exact prefixes of it and are read off the same pass over the rows; all
    models of a fold score its rows in one pass (``models.grid_scores``).
    """
    from .parallel import parallel_map
    n_max = max(grid["n_estimators"])
    df = persist_shared(df)
    parts = cv.fit_parts(df.sparkSession, df.count())

    def prepare_fold(k):
        train = df.filter(F.col("fold") != k)
        val = df.filter(F.col("fold") == k)
        fp = prep.fit(train)
        tr = MD.pos_weight(fp.transform(train).select(label, "features"), label).repartition(parts).cache()
        va = fp.transform(val).select(label, "features").repartition(parts).cache()
        tr.count()
        va.count()
        return tr, va

    folds = dict(zip(range(C.N_FOLDS), parallel_map(prepare_fold, range(C.N_FOLDS))))

    items = [(k, d, lr) for k in range(C.N_FOLDS) for d in grid["max_depth"] for lr in grid["learning_rate"]]
    specs = [(k, MD.ModelSpec("gbt", "gbt", {"n_estimators": n_max, "max_depth": d, "learning_rate": lr}, "pos")) for k, d, lr in items]
    fitted = dict(zip(items, MD.boosted_fits([folds[k][0] for k in range(C.N_FOLDS)], specs, label)))

    names, keys = ["max_depth", "learning_rate"], ["fold", "max_depth", "learning_rate", "n_estimators"]

    def scores(split: int) -> DataFrame:
        """Scores of the training (0) or validation (1) rows of all folds by all models."""
        out = None
        for k, parts_of in folds.items():
            models = {(int(d), float(lr)): fitted[k, d, lr] for d in grid["max_depth"] for lr in grid["learning_rate"]}
            s = MD.grid_scores(models, names, parts_of[split], grid["n_estimators"], [label]).withColumn("fold", F.lit(int(k)))
            out = s if out is None else out.unionByName(s)
        return out

    s_tr = persist_shared(scores(0))
    thr = curves.best_threshold(s_tr, keys, "y_prob", label).select(*keys, "threshold")
    pred = scores(1).join(F.broadcast(thr), keys).withColumn(   # one threshold a fold and configuration
        "y_pred", M.apply_threshold("y_prob", F.col("threshold")))
    f2 = pred.groupBy(*keys).agg(*M.confusion_aggs(label, "y_pred")).select(*keys, M.f2().alias("f2"))
    rows = [(int(r["n_estimators"]), int(r["max_depth"]), float(r["learning_rate"]), int(r["fold"]), float(r["f2"])) for r in f2.collect()]
    for x in [df, s_tr, *(x for pair in folds.values() for x in pair)]:
        x.unpersist()
    t = df.sparkSession.createDataFrame(rows, "n_estimators int, max_depth int, learning_rate double, fold int, f2 double")
    g = t.groupBy("n_estimators", "max_depth", "learning_rate").agg(F.avg("f2").alias("mean_f2"),
                                                                    F.stddev_samp("f2").alias("std_f2"))
    w = Window.orderBy(F.col("mean_f2").desc(), "n_estimators", "max_depth", "learning_rate")  # one row per config
    return g.withColumn("rank", F.row_number().over(w))


def learning_curve(df: DataFrame, prep: FE.Preprocessor, row_id: str = "case_id",
                   sizes=(0.2, 0.4, 0.6, 0.8, 1.0)) -> DataFrame:
    """Train / validation F1 per training size on ungrouped stratified folds."""
    from .parallel import parallel_map
    strat = SP.stratified_folds(df.drop("fold"), row_id).cache()
    spec = MD.reference_models()[0]

    def one(item):
        k, f = item
        train = SP.training_prefix(strat.filter(F.col("fold") != k), row_id, f)
        val = strat.filter(F.col("fold") == k)
        fp = prep.fit(train)
        tr = MD.weighted(fp.transform(train), spec)
        n_w = tr.agg(F.sum("w")).first()[0]
        model = spec.fit(tr, float(n_w))
        out = []
        for name, part in (("train", tr), ("val", fp.transform(val))):
            sc = model.transform(part).select("escalated", F.col("prediction").cast("int").alias("p"))
            r = sc.agg(*M.confusion_aggs("escalated", "p")).select(M.f_beta(beta=1.0).alias("f1")).first()
            out.append((float(f), k, name, float(r["f1"])))
        return out

    rows = [r for rs in parallel_map(one, [(k, f) for k in range(C.N_FOLDS) for f in sizes]) for r in rs]
    spark = df.sparkSession
    t = spark.createDataFrame(rows, "size double, fold int, split string, f1 double")
    g = t.groupBy("size").pivot("split", ["train", "val"]).agg(F.avg("f1"))
    g = g.select("size", F.col("train").alias("train_f1"), F.col("val").alias("val_f1"),
                 (F.col("train") - F.col("val")).alias("gap"))
    verdict = F.when(F.col("gap") > 0.15, "HIGH VARIANCE").when(F.col("gap") > 0.05, "moderate variance").otherwise("low variance")
    return g.withColumn("verdict", verdict)


def pca_study(df: DataFrame, prep: FE.Preprocessor, sizes=C.PCA_SIZES, var_target: float = 0.90) -> DataFrame:
    """LR on k principal components per fold, tuned threshold; k in sizes plus the 90%-variance count (K9)."""
    from .parallel import parallel_map
    spark = df.sparkSession
    df = persist_shared(df)
    parts = cv.fit_parts(df.sparkSession, df.count())

    def one_fold(k_fold):
        rows = []
        train = df.filter(F.col("fold") != k_fold)
        val = df.filter(F.col("fold") == k_fold)
        fp = prep.fit(train)
        tr = fp.transform(train).repartition(parts).cache()
        va = fp.transform(val).repartition(parts)
        dims = len(fp.feature_names())
        # one decomposition a fold: the first k components of it are the components at size k
        sc_full, pca_full = MD.pca_fit(tr, dims)
        tr_all, va_all = (MD.pca_transform(x, sc_full, pca_full).select("escalated", "pcs").cache() for x in (tr, va))
        ev = list(pca_full.explainedVariance.toArray())
        cum, n90 = 0.0, dims
        for i, v in enumerate(ev):
            cum += v
            if cum >= var_target:
                n90 = i + 1
                break
        for label, size in [(f"PCA_{z}", z) for z in sizes] + [("PCA_var90", n90)]:
            kk = min(size, dims)
            first = VectorSlicer(inputCol="pcs", outputCol="features", indices=list(range(kk)))
            trp, vap = (first.transform(x).drop("pcs") for x in (tr_all, va_all))
            spec = MD.reference_models()[0]
            trw = MD.weighted(trp, spec)
            model = spec.fit(trw, float(trw.agg(F.sum("w")).first()[0]))
            s_tr = MD.positive_probability(model.transform(trp)).select("escalated", "y_prob")
            thr = curves.best_threshold(s_tr, []).first()["threshold"]
            s_va = MD.positive_probability(model.transform(vap)).withColumn("y_pred", M.apply_threshold("y_prob", thr))
            r = s_va.agg(*M.confusion_aggs()).select(M.f2().alias("f2")).first()
            rows.append((label, int(size), int(kk), k_fold, float(r["f2"]), float(sum(ev[:kk]))))
        for x in (tr, tr_all, va_all):
            x.unpersist()
        return rows

    rows = [r for rs in parallel_map(one_fold, range(C.N_FOLDS)) for r in rs]
    t = spark.createDataFrame(rows, "config string, n_components int, used_components int, fold int, f2 double, var double")
    return t.groupBy("config").agg(F.avg("n_components").alias("n_components"), F.avg("used_components").alias("used_components"),
                                   F.avg("f2").alias("f2_mean"), F.stddev_pop("f2").alias("f2_std"),
                                   F.avg("var").alias("variance_explained"))


def explained_variance(df: DataFrame, prep: FE.Preprocessor) -> DataFrame:
    """Per component: explained variance ratio and cumulative share; flags at 90% / 95% (F4, I6 fit on all rows)."""
    fp = prep.fit(df)
    x = fp.transform(df).cache()
    dims = len(fp.feature_names())
    _, pca = MD.pca_fit(x, dims)
    ev = [float(v) for v in pca.explainedVariance.toArray()]
    spark = df.sparkSession
    t = spark.createDataFrame([(i + 1, v) for i, v in enumerate(ev)], "component int, explained_variance double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # one row per component
    t = t.withColumn("cumulative", F.sum("explained_variance").over(w))
    first90 = t.filter(F.col("cumulative") >= 0.90).agg(F.min("component")).first()[0]
    first95 = t.filter(F.col("cumulative") >= 0.95).agg(F.min("component")).first()[0]
    return t.withColumn("n_for_90", F.lit(first90)).withColumn("n_for_95", F.lit(first95))


def kmeans_study(df: DataFrame, prep: FE.Preprocessor, ks=C.KMEANS_KS, n_pcs: int = 50, restarts: int = 10,
                 score_rows: int | None = None, row_id: str = "case_id") -> DataFrame:
    """K-Means on principal components for each k (best of ``restarts`` seeds): silhouette
    (squared Euclidean), escalation-rate range across clusters (K10, K11).

    Everything is fitted on all rows; with ``score_rows`` the silhouette is that
    of a seeded sample of them (J4), counted in ``scored_rows``.
    """
    fp = prep.fit(df)
    x = fp.transform(df)
    dims = len(fp.feature_names())
    sc, pca = MD.pca_fit(x, min(n_pcs, dims))
    xp = MD.pca_transform(x, sc, pca).select(row_id, "escalated", "pcs").cache()
    scored = xp if score_rows is None else SP.seeded_sample(xp, row_id, score_rows).cache()
    n_scored = scored.count()
    ev = ClusteringEvaluator(featuresCol="pcs", predictionCol="cluster", distanceMeasure="squaredEuclidean")
    rows = []
    fits = MD.kmeans_best(xp, ks, "pcs", restarts)
    for k in ks:
        model, cost = fits[k]
        pred = model.transform(xp)
        sil = ev.evaluate(pred if score_rows is None else model.transform(scored))
        rates = pred.groupBy("cluster").agg(F.avg("escalated").alias("r")).agg(F.min("r"), F.max("r")).first()
        rows.append((int(k), float(cost), float(sil), float(rates[0]), float(rates[1])))
    spark = df.sparkSession
    t = spark.createDataFrame(rows, "k int, training_cost double, silhouette_sq_euclidean double, min_rate double, max_rate double")
    w = Window.orderBy(F.col("silhouette_sq_euclidean").desc(), "k")  # one row per k
    return t.withColumn("scored_rows", F.lit(n_scored).cast("long")).withColumn("rate_range", F.col("max_rate") - F.col("min_rate")).withColumn("rank", F.row_number().over(w))


def cluster_profile(df: DataFrame, prep: FE.Preprocessor, k: int, n_pcs: int = 50, restarts: int = 10) -> DataFrame:
    """Size and escalation rate per cluster at a given k (K10 profile)."""
    fp = prep.fit(df)
    x = fp.transform(df)
    sc, pca = MD.pca_fit(x, min(n_pcs, len(fp.feature_names())))
    xp = MD.pca_transform(x, sc, pca).select("escalated", "pcs").cache()
    model, _ = MD.kmeans_best(xp, [k], "pcs", restarts)[k]
    return model.transform(xp).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("escalated").alias("escalation_rate"))


def feature_ablation(df: DataFrame, configs: dict[str, FE.Preprocessor], baseline: str = "full",
                     metric: str = "f2_tuned") -> DataFrame:
    """Per preprocessing config: F2 mean / population std, PR-AUC, recall, precision; delta vs baseline.

    ``metric``: the fold F2 that is compared, ``f2_tuned`` or ``f2_default``.
    """
    spec = MD.reference_models()[0]
    parts = []
    for name, prep in configs.items():
        s = cv.cv_scores(df, [spec], prep)
        fm = cv.cv_fold_metrics(s).withColumn("model", F.lit(name))
        parts.append(fm.withColumn("f2_tuned", F.col(metric)))
    fm = parts[0]
    for p in parts[1:]:
        fm = fm.unionByName(p)
    fm = fm.cache()
    t = _fold_f2_table(fm).withColumnRenamed("model", "configuration")
    base_f2 = float(t.filter(F.col("configuration") == baseline).first()["f2_mean"])  # one scalar
    tt = paired_vs_baseline(fm, baseline).withColumnRenamed("model", "configuration").drop("mean_diff_vs_baseline")
    return t.withColumn("delta_vs_baseline", F.col("f2_mean") - F.lit(base_f2)).join(tt, "configuration", "left")


def drop_feature_ablation(df: DataFrame, prep: FE.Preprocessor, col: str = "sentiment") -> DataFrame:
    """F2 at the default decision with and without one categorical column.

    Signed rule on what the column adds, full minus without: under 0.02 either
    way is negligible, only a gain of more than 0.05 substantial, the rest
    small. The full configuration is the base and has no verdict.
    """
    without = FE.Preprocessor(prep.text_col, [c for c in prep.cat_cols if c != col], prep.num_cols, prep.spec)
    t = feature_ablation(df, {"full": prep, f"without_{col}": without}, metric="f2_default")
    gain = -F.col("delta_vs_baseline")
    verdict = (F.when(F.col("configuration") == "full", F.lit(None).cast("string"))
               .when(F.abs(gain) < 0.02, "negligible").when(gain > 0.05, "substantial").otherwise("small"))
    return t.withColumn("verdict", verdict)


def representative_fold(df: DataFrame, prep: FE.Preprocessor, fold: int = 0):
    """LR fitted on the training rows of one fold (L12): (model, fitted preprocessor, train, val)."""
    train = df.filter(F.col("fold") != fold)
    val = df.filter(F.col("fold") == fold)
    fp = prep.fit(train)
    spec = MD.reference_models()[0]
    tr = MD.weighted(fp.transform(train), spec).cache()
    model = spec.fit(tr, float(tr.agg(F.sum("w")).first()[0]))
    return model, fp, tr, fp.transform(val)


def fold_coefficients(df: DataFrame, prep: FE.Preprocessor, fold: int = 0) -> DataFrame:
    model, fp, _, _ = representative_fold(df, prep, fold)
    return IN.coefficient_table(df.sparkSession, fp.feature_names(), list(model.coefficients.toArray()))


def fold_permutation_importance(df: DataFrame, prep: FE.Preprocessor, fold: int = 0) -> DataFrame:
    model, fp, tr, va = representative_fold(df, prep, fold)
    s_tr = MD.positive_probability(model.transform(tr)).select("escalated", "y_prob")
    thr = float(curves.best_threshold(s_tr, []).first()["threshold"])
    return IN.permutation_importance(va, fp, list(model.coefficients.toArray()), float(model.intercept), thr)


def fold_row_contributions(df: DataFrame, prep: FE.Preprocessor, fold: int = 0) -> DataFrame:
    model, fp, tr, va = representative_fold(df, prep, fold)
    names = fp.feature_names()
    means_row = tr.select(F.posexplode(vector_to_array("features")).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"))
    means = {r["i"]: r["m"] for r in means_row.collect()}  # one value per feature
    mu = [float(means.get(i, 0.0)) for i in range(len(names))]
    return IN.row_contributions(va, names, list(model.coefficients.toArray()), mu, float(model.intercept))


def fold_local_weights(df: DataFrame, prep: FE.Preprocessor, fold: int = 0, row_id: str = "case_id") -> DataFrame:
    """Local surrogate weights of a fold's representative validation rows, ten features each (M3)."""
    model, fp, tr, va = representative_fold(df, prep, fold)
    thr = float(curves.best_threshold(MD.positive_probability(model.transform(tr)).select("escalated", "y_prob"), []).first()["threshold"])
    va = va.select(row_id, "escalated", "features")
    scored = MD.positive_probability(model.transform(va)).select(row_id, "escalated", "y_prob").withColumn(
        "y_pred", M.apply_threshold("y_prob", thr)).cache()
    picks = IN.representative_rows(scored, row_id).select(row_id, "prediction_type", "pick", "y_prob").cache()
    rows = va.join(picks.select(row_id).distinct(), row_id)
    names = fp.feature_names()
    w = SU.local_weights(rows, row_id, names, SU.spread(tr),
                         lambda x: MD.positive_probability(model.transform(x)).withColumnRenamed("y_prob", "_y"))
    return picks.join(w, row_id)


def _fold_spaces(df: DataFrame, prep: FE.Preprocessor, row_id: str) -> DataFrame:
    """Every row in the features of every fold's preprocessor: ``k``, ``_id`` (one for each row and fold), ``val``, label, ``vec``."""
    from .parallel import parallel_map
    whole = isinstance(df.schema[row_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))

    def space(k: int) -> DataFrame:
        name = F.col(row_id).cast("long") * C.N_FOLDS + k if whole else F.concat_ws("|", F.lit(k), F.col(row_id))
        return prep.fit(df.filter(F.col("fold") != k)).transform(df).select(
            F.lit(k).alias("k"), name.alias("_id"), (F.col("fold") == k).alias("val"), "escalated",
            vector_to_array("features").alias("vec"))

    spaces = parallel_map(space, range(C.N_FOLDS))
    rows = spaces[0]
    for s in spaces[1:]:
        rows = rows.unionByName(s)
    return rows


def _set_apart(rows: DataFrame) -> DataFrame:
    """Vectors padded to one width, with a last place of their fold's own: rows of two folds are farther from each other than
    any two rows of one fold, and distances within a fold stay as they are."""
    square = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    width, most = rows.agg(F.max(F.size("vec")), F.max(square)).first()
    apart = 4.0 * (float(most or 0.0) ** 0.5 + 1.0)
    padding = F.array_repeat(F.lit(0.0), F.lit(int(width or 0)) - F.size("vec"))
    return rows.withColumn("vec", F.concat("vec", padding, F.array(F.col("k") * F.lit(apart))))


def knn_study(df: DataFrame, prep: FE.Preprocessor, ks=C.KNN_KS, row_id: str = "case_id") -> DataFrame:
    """kNN vote share for every k from one exact top-max(k) search over all folds; tuned thresholds (K6).

    Training-row scores include the row itself, as the reference's do. A fold
    with fewer training rows than k votes with all of them.
    """
    spaces = persist_shared(_fold_spaces(df, prep, row_id))
    rows = _set_apart(spaces)
    points = rows.where(~F.col("val")).select(F.col("_id").alias("_pid"), "vec")
    voter = rows.where(~F.col("val")).select(F.col("_id").alias("_pid"), F.col("k").alias("_pk"), F.col("escalated").alias("_py"))
    nn = SP.knn(rows.select("_id", "vec"), points, max(ks), "_id", "_pid", "vec").join(voter, "_pid")
    scored = (nn.join(rows.select("_id", "k", "val", "escalated"), "_id").where("k = _pk").groupBy("_id", "k", "val", "escalated")
              .agg(*[F.avg(F.when(F.col("rank") <= n, F.col("_py"))).alias(str(n)) for n in ks])
              .unpivot(["_id", "k", "val", "escalated"], [str(n) for n in ks], "n_neighbours", "y_prob"))
    scored = cut_lineage(scored.withColumn("n_neighbours", F.col("n_neighbours").cast("int")))
    spaces.unpersist()
    keys = ["k", "n_neighbours"]
    thr = curves.best_threshold(scored.where(~F.col("val")), keys).select(*keys, "threshold")
    per = (scored.where("val").join(F.broadcast(thr), keys)     # one row per fold and k
           .withColumn("y_pred", M.apply_threshold("y_prob", F.col("threshold")))
           .groupBy(*keys).agg(*M.confusion_aggs()).select(*keys, M.f2().alias("f2")))
    t = per.groupBy(F.col("n_neighbours").alias("k")).agg(F.avg("f2").alias("f2_mean"), F.stddev_pop("f2").alias("f2_std"))
    w = Window.orderBy(F.col("f2_mean").desc(), "k")  # one row per k
    return t.withColumn("rank", F.row_number().over(w))


def knn_vote(emb: DataFrame, k: int = 5) -> DataFrame:
    """Leave-one-out kNN majority label per point (exact neighbours, ties by id / smallest label) (K6)."""
    pts = emb.select(F.col("vec_id").alias("_nb"), F.col("embedding").alias("vec"))
    q = emb.select("vec_id", F.col("embedding").alias("vec"))
    nn = SP.knn(q, pts, k, "vec_id", "_nb", "vec", exclude_self=True)
    lab = emb.select(F.col("vec_id").alias("_nb"), F.col("label").alias("_nl"))
    v = nn.join(lab, "_nb").groupBy("vec_id", "_nl").agg(F.count(F.lit(1)).alias("c"))
    best = v.groupBy("vec_id").agg(F.min_by("_nl", F.struct((-F.col("c")).alias("a"), F.col("_nl").alias("b"))).alias("predicted_label"),
                                   F.max("c").alias("votes"))
    return best.join(emb.select("vec_id", "label"), "vec_id").select(
        "vec_id", "label", "predicted_label", (F.col("votes") / float(k)).alias("vote_share"))
