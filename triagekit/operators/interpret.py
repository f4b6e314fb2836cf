"""Model interpretation.

Linear models are explained exactly: a row's logit is the sum of per-raw-column
contributions, so permutation importance moves each row's array of
contributions once a repeat and reads all columns of a repeat from that one
move, instead of re-scoring the model once per column and repeat.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..session import persist_shared
from . import curves
from . import splits as SP


def coefficient_table(spark: SparkSession, names: list[str], coefs: list[float]) -> DataFrame:
    """(feature, coefficient) paired by position (C5); size = number of features."""
    return spark.createDataFrame([(n, float(c)) for n, c in zip(names, coefs)], "feature string, coefficient double")


def coefficient_importance(coef: DataFrame, k: int = 15) -> DataFrame:
    """Signed / absolute weight, cleaned name, direction, top-k positive and negative ranks."""
    from pyspark.sql import Window
    x = coef.select("feature", "coefficient", F.abs("coefficient").alias("abs_coefficient"),
                    F.regexp_replace("feature", r"^(text|cat|num)__", "").alias("clean_name"),
                    F.when(F.col("coefficient") > 0, "+").otherwise("-").alias("direction"))
    # coefficient tables have one row per feature (bounded by the vocabulary size)
    wp = Window.orderBy(F.col("coefficient").desc(), "feature")
    wn = Window.orderBy(F.col("coefficient").asc(), "feature")
    x = x.withColumn("rank_pos", F.row_number().over(wp)).withColumn("rank_neg", F.row_number().over(wn))
    return x.withColumn("top_positive", F.col("rank_pos") <= k).withColumn("top_negative", F.col("rank_neg") <= k)


def feature_blocks(coef: DataFrame) -> DataFrame:
    """Feature count per block prefix text / cat / num."""
    return coef.groupBy(F.substring_index("feature", "__", 1).alias("block")).agg(F.count(F.lit(1)).alias("n_features"))


def raw_column_slices(prep) -> list[tuple[str, int, int]]:
    """(raw column, start index, length) of each raw input inside the assembled vector."""
    out, pos = [], 0
    if prep.tfidf is not None:
        n = len(prep.tfidf.vocab)
        out.append((prep.text_col, pos, n))
        pos += n
    if prep.onehot is not None:
        for c, vals in prep.onehot.categories.items():
            n = max(len(vals) - 1, 0)
            out.append((c, pos, n))
            pos += n
    if prep.scaler is not None:
        for c in prep.scaler.means:
            out.append((c, pos, 1))
            pos += 1
    return out


def contributions(df: DataFrame, prep, coefs: list[float], intercept: float, features: str = "features") -> DataFrame:
    """Per row: logit and an array of per-raw-column contributions (struct column, value)."""
    arr = vector_to_array(features)
    parts = []
    for name, s, n in raw_column_slices(prep):
        if n == 0:
            v = F.lit(0.0)
        else:
            cs = F.array(*[F.lit(float(c)) for c in coefs[s:s + n]])
            v = F.aggregate(F.zip_with(F.slice(arr, s + 1, n), cs, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)
        parts.append(F.struct(F.lit(name).alias("column"), v.alias("value")))
    x = df.withColumn("_contrib", F.array(*parts))
    return x.withColumn("logit", F.aggregate("_contrib", F.lit(float(intercept)), lambda acc, t: acc + t["value"]))


def permutation_importance(val: DataFrame, prep, coefs: list[float], intercept: float, threshold: float,
                           row_id: str = "case_id", label: str = "escalated", repeats: int = C.PERMUTATION_REPEATS,
                           seed: int = C.SEED) -> DataFrame:
    """Mean / population std of the F2 drop when one raw column is permuted.

    Exact for a linear model: permuting a raw column permutes its logit
    contribution. One permutation a repeat moves the whole array of
    contributions; the columns are told apart after the join, before a partial
    aggregation, so a row is shuffled once a repeat whatever the columns.
    """
    x = contributions(val, prep, coefs, intercept).select(F.col(row_id).cast("string").alias(row_id), label, "logit", "_contrib")
    x = persist_shared(x)  # read by both position tables and the base run
    hashed = x.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn(
        "_h", F.xxhash64(F.col(row_id), F.col("rep"), F.lit(seed)))
    by_h = SP._positions(hashed, ["rep"], "_h", F.pmod(F.col("_h"), F.lit(SP.HASH_BUCKETS)))
    by_id = SP._positions(x.select(row_id, F.col("_contrib.value").alias("_moved"), F.lit(0).alias("_k")), ["_k"], row_id,
                          F.pmod(F.xxhash64(F.col(row_id)), F.lit(SP.HASH_BUCKETS))).select("_pos", "_moved")
    j = by_h.join(by_id, "_pos").select(label, "logit", "rep", F.inline(F.arrays_zip(
        F.col("_contrib.column").alias("column"), F.col("_contrib.value").alias("value"), F.col("_moved").alias("pvalue"))))
    newp = 1.0 / (1.0 + F.exp(-(F.col("logit") - F.col("value") + F.col("pvalue"))))
    j = j.withColumn("y_pred", (newp >= F.lit(float(threshold))).cast("int"))
    keys = ["column", "rep"]
    per_run = j.groupBy(*keys).agg(*M.confusion_aggs(label, "y_pred")).select(*keys, M.f2().alias("f2"))
    base = x.select(label, ((1.0 / (1.0 + F.exp(-F.col("logit")))) >= F.lit(float(threshold))).cast("int").alias("y_pred"))
    b = base.agg(*M.confusion_aggs(label, "y_pred")).select(M.f2().alias("base_f2"))
    r = per_run.withColumn("base_f2", F.lit(float(b.first()["base_f2"])))  # one scalar
    r = r.withColumn("drop", F.col("base_f2") - F.col("f2"))
    g = r.groupBy("column").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
    sig = (F.col("importance_mean") > 2 * F.col("importance_std")) & (F.col("importance_mean") > 0.005)
    return g.select(F.col("column").alias("feature"), "importance_mean", "importance_std", sig.alias("significant"))


def row_contributions(df: DataFrame, names: list[str], coefs: list[float], means: list[float], intercept: float,
                      row_id: str = "case_id", k: int = C.TOP_FEATURES, features: str = "features") -> DataFrame:
    """Top-k additive logit contributions coef * (x - mean) per row (M3), as array<struct<feature, weight>>."""
    arr = vector_to_array(features)
    nm = F.array(*[F.lit(n) for n in names])
    cf = F.array(*[F.lit(float(c)) for c in coefs])
    mu = F.array(*[F.lit(float(m)) for m in means])
    w = F.zip_with(F.zip_with(arr, mu, lambda a, b: a - b), cf, lambda a, b: a * b)
    st = F.arrays_zip(nm.alias("feature"), w.alias("weight"))
    keyed = F.transform(st, lambda s: F.struct((-F.abs(s["weight"])).alias("k"), s["feature"].alias("feature"),
                                               s["weight"].alias("weight")))
    top = F.slice(F.sort_array(F.filter(keyed, lambda s: s["weight"] != 0)), 1, k)
    top = F.transform(top, lambda s: F.struct(s["feature"].alias("feature"), s["weight"].alias("weight")))
    logit = F.aggregate(F.zip_with(arr, cf, lambda a, b: a * b), F.lit(float(intercept)), lambda acc, t: acc + t)
    return df.select(row_id, (1.0 / (1.0 + F.exp(-logit))).alias("predicted_prob"), top.alias("top_features"))


def representative_rows(scored: DataFrame, row_id: str = "case_id") -> DataFrame:
    """Example rows: TP highest and median score, FN highest and lowest, FP highest.

    Extremes are max_by/min_by aggregates (ties -> lowest id); the median-ranked
    TP is an exact order statistic found with bucketed prefix sums, never a
    whole-class window, even when many rows share one score.
    """
    lab = scored.withColumn("prediction_type", M.prediction_type())
    ext = lab.groupBy("prediction_type").agg(
        F.min_by(row_id, F.struct((-F.col("y_prob")).alias("a"), F.col(row_id).alias("b"))).alias("hi"),
        F.min_by(row_id, F.struct(F.col("y_prob").alias("a"), F.col(row_id).alias("b"))).alias("lo"),
        F.count(F.lit(1)).alias("n"))
    picks = ext.select("prediction_type", "n", F.explode(F.array(
        F.struct(F.lit("highest").alias("pick"), F.col("hi").alias(row_id)),
        F.struct(F.lit("lowest").alias("pick"), F.col("lo").alias(row_id)))).alias("x")).select(
        "prediction_type", "n", "x.pick", F.col(f"x.{row_id}").alias(row_id))
    keep = ((F.col("prediction_type") == "TP") & (F.col("pick") == "highest")) | \
           ((F.col("prediction_type") == "FN") & ((F.col("pick") == "highest") | (F.col("n") > 1))) | ((F.col("prediction_type") == "FP") & (F.col("pick") == "highest"))
    picks = picks.filter(keep).drop("n")   # a class of one row has one pick
    # median-ranked TP, rank n // 2 by descending score and then id: find the score holding the rank from a per-score
    # histogram, then rank only the rows with that score by id (both steps bucketed, exact)
    tp = lab.filter(F.col("prediction_type") == "TP")
    n_tp = ext.filter(F.col("prediction_type") == "TP").select("n").first()
    if n_tp is None or n_tp["n"] < 2:
        med = lab.limit(0).select(F.lit("TP").alias("prediction_type"), F.lit("median").alias("pick"), row_id)
    else:
        target = int(n_tp["n"]) // 2
        hist = tp.groupBy("y_prob").agg(F.count(F.lit(1)).alias("c"))
        cum = curves.cumulative(hist, [], "y_prob", ["c"])
        hit = cum.filter((F.col("cum_c") - F.col("c") <= target) & (F.col("cum_c") > target)).first()
        sub = tp.filter(F.col("y_prob") == F.lit(hit["y_prob"])).withColumn("_k", F.lit(0))
        pos = SP._positions(sub.select("_k", row_id), ["_k"], row_id, curves.cut_bucket(sub, row_id))
        offset = target - (int(hit["cum_c"]) - int(hit["c"]))
        med = pos.filter(F.col("_pos") == offset).select(F.lit("TP").alias("prediction_type"),
                                                          F.lit("median").alias("pick"), row_id)
    allp = picks.unionByName(med)
    return allp.join(lab.select(row_id, "y_prob", "escalated", "prediction_type"), [row_id, "prediction_type"])
