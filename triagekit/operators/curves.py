"""Score curves: precision-recall curve, PR-AUC, F2-best threshold, threshold sweep.

All of them reduce rows to a histogram ``(keys, score) -> (n, pos)`` first
(map-side partial aggregation), then need prefix sums in descending score
order. A global ordered window would run on one task, so the prefix sum is
two-level: values are cut into ``BUCKETS`` buckets at their quantiles, bucket
totals get their offsets from a window over at most ``BUCKETS`` rows per key,
and the exact running sum inside a bucket is a window partitioned by (keys,
bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import metrics as M

# Buckets of a prefix sum: cut at quantiles of the histogram itself, so that an
# outlier or values crowded in one place still leave every bucket about equal.
BUCKETS = 256


def cut_points(df: DataFrame, col: str, buckets: int = BUCKETS) -> list:
    """At most ``buckets - 1`` ascending cut values of a column; any orderable type.

    Approximate quantiles for numbers and times; for other types the sorted
    values of a bounded hash sample. Cut values only shape the buckets.
    """
    kind = df.schema[col].dataType
    if isinstance(kind, (T.NumericType, T.DatetimeType)):
        probs = [i / buckets for i in range(1, buckets)]
        cuts = df.agg(F.percentile_approx(col, probs, 10 * buckets).alias("c")).first()["c"] or []
    else:
        order = F.xxhash64(col)
        cuts = [r[0] for r in df.where(F.col(col).isNotNull()).select(col).orderBy(order).limit(buckets - 1).collect()]
    return sorted(set(cuts))


def cut_bucket(df: DataFrame, col: str, buckets: int = BUCKETS) -> Column:
    """Bucket index: the cut points of ``df`` that are not above the value; ascending with the column."""
    kind, cuts = df.schema[col].dataType, cut_points(df, col, buckets)
    if not cuts:
        return F.lit(0)
    points = F.array(*[F.lit(c).cast(kind) for c in cuts])      # one literal once folded
    return F.size(F.filter(points, lambda c: c <= F.col(col)))


def cumulative(hist: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
               descending: bool = True, bucket: Column | None = None,
               prefix: str = "cum_") -> DataFrame:
    """Exact running sums of ``value_cols`` per ``keys`` in ``order_col`` order.

    ``hist`` must have one row per (keys, order_col). The running sum includes
    the current row. Parallel: no window spans more than one bucket, and the
    bucket-offset window spans at most the bucket count per key.
    """
    b = bucket if bucket is not None else cut_bucket(hist, order_col)
    h = hist.withColumn("_b", b)
    tot = h.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    ob = F.col("_b").desc() if descending else F.col("_b").asc()
    wb = Window.partitionBy(*keys).orderBy(ob).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_b", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}")
                                     for c in value_cols])
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    wi = Window.partitionBy(*keys, "_b").orderBy(oc).rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(off, keys + ["_b"])
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.sum(c).over(wi))
    return out.drop("_b", *[f"_o_{c}" for c in value_cols])


def score_histogram(df: DataFrame, keys: list[str], score: str = "y_prob",
                    label: str = "escalated") -> DataFrame:
    """(keys, score) -> n, pos: the only pass over rows."""
    return (df.groupBy(*keys, score)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")))


def pr_curve(df: DataFrame, keys: list[str] | None = None, score: str = "y_prob",
             label: str = "escalated", hist: DataFrame | None = None) -> DataFrame:
    """Precision-recall curve at every distinct score (F1).

    Output per (keys, threshold): tp, fp (rows with score >= threshold),
    precision, recall, f2, and the previous (higher-threshold) point's
    precision/recall for the trapezoid; recall is 1 when a key has no positives.
    """
    keys = list(keys or [])
    h = hist if hist is not None else score_histogram(df, keys, score, label)
    h = h.withColumnRenamed(score, "threshold") if score != "threshold" else h
    cum = cumulative(h, keys, "threshold", ["n", "pos"])
    if keys:
        # one row per key; the planner broadcasts it when AQE measures it small
        cum = cum.join(h.groupBy(*keys).agg(F.sum("pos").alias("n_pos_total")), keys)
    else:
        total = h.agg(F.sum("pos")).first()[0] or 0  # a single scalar
        cum = cum.withColumn("n_pos_total", F.lit(int(total)))
    tp, nn, P = F.col("cum_pos"), F.col("cum_n"), F.col("n_pos_total")
    tp0, nn0 = tp - F.col("pos"), nn - F.col("n")
    rec = F.when(P == 0, F.lit(1.0)).otherwise(tp / P)
    rec0 = F.when(P == 0, F.lit(1.0)).otherwise(tp0 / P)
    return cum.select(
        *keys, "threshold", tp.alias("tp"), (nn - tp).alias("fp"),
        (tp / nn).alias("precision"), rec.alias("recall"),
        F.when(nn0 > 0, tp0 / nn0).otherwise(F.lit(1.0)).alias("prev_precision"),
        F.when(nn0 > 0, rec0).otherwise(F.lit(0.0)).alias("prev_recall"),
    ).withColumn("f2", M.f2_from_pr("precision", "recall"))


def pr_auc(df: DataFrame, keys: list[str] | None = None, score: str = "y_prob",
           label: str = "escalated", curve: DataFrame | None = None) -> DataFrame:
    """Trapezoid area under the PR curve, ending at (recall 0, precision 1) (F2)."""
    keys = list(keys or [])
    cv = curve if curve is not None else pr_curve(df, keys, score, label)
    area = (F.col("recall") - F.col("prev_recall")) * (F.col("precision") + F.col("prev_precision")) / 2
    return cv.groupBy(*keys).agg(F.sum(area).alias("pr_auc"))


def best_threshold(df: DataFrame, keys: list[str] | None = None, score: str = "y_prob",
                   label: str = "escalated", curve: DataFrame | None = None) -> DataFrame:
    """Smallest score reaching the maximum F2 on the curve (F3); one row per key."""
    keys = list(keys or [])
    cv = curve if curve is not None else pr_curve(df, keys, score, label)
    pick = F.min_by(F.col("threshold"), F.struct((-F.col("f2")).alias("a"), F.col("threshold").alias("b")))
    return cv.groupBy(*keys).agg(pick.alias("threshold"), F.max("f2").alias("train_f2"))


def fold_thresholds(scored: DataFrame, fold: str = "fold", score: str = "y_prob",
                    label: str = "escalated", n_folds: int = C.N_FOLDS) -> DataFrame:
    """Per-fold F2-best threshold tuned on that fold's *training* rows.

    One pass builds per-score counts for every fold at once; training counts
    are total minus own fold, so no fold is re-scanned.
    """
    per = scored.groupBy(score).agg(
        F.count(F.lit(1)).alias("n_all"), F.sum(F.col(label).cast("long")).alias("pos_all"),
        F.array(*[F.count_if(F.col(fold) == k) for k in range(n_folds)]).alias("n_f"),
        F.array(*[F.count_if((F.col(fold) == k) & (F.col(label) == 1)) for k in range(n_folds)]).alias("pos_f"))
    ex = per.select(score, "n_all", "pos_all",
                    F.posexplode(F.arrays_zip("n_f", "pos_f")).alias("k", "z"))
    train = ex.select(F.col("k").cast("int").alias(fold), F.col(score),
                      (F.col("n_all") - F.col("z.n_f")).alias("n"),
                      (F.col("pos_all") - F.col("z.pos_f")).alias("pos")).filter(F.col("n") > 0)
    curve = pr_curve(None, [fold], score, label, hist=train)
    return best_threshold(None, [fold], curve=curve)


def threshold_sweep(scored: DataFrame, grid: list[float] | None = None, score: str = "y_prob",
                    label: str = "escalated", fn_cost: int = C.COST_FN, fp_cost: int = C.COST_FP,
                    tp_cost: int = C.COST_TP) -> DataFrame:
    """Metrics at each grid threshold in one scan.

    Each row maps to the number of grid points at or below its score; the
    per-index histogram (at most len(grid)+1 rows) is summed in reverse to give
    counts at every threshold.
    """
    grid = grid or C.threshold_grid()
    # number of grid points at or below the score: plain comparisons, so it stays in whole-stage codegen
    idx = None
    for t in grid:
        term = (F.col(score) >= F.lit(float(t))).cast("int")
        idx = term if idx is None else idx + term
    h = (scored.select(idx.alias("k"), F.col(label).cast("long").alias("y"))
         .groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")))
    spark = scored.sparkSession
    g = spark.createDataFrame([(i + 1, t) for i, t in enumerate(grid)], "k int, threshold double")
    # <= len(grid)+1 index rows: windows over this tiny frame are bounded
    full = h.join(g, "k", "full").fillna(0, subset=["n", "pos"])
    wd = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    wa = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = full.select("k", "threshold", F.sum("n").over(wd).alias("flag_n"), F.sum("pos").over(wd).alias("flag_pos"),
                    F.sum("n").over(wa).alias("n_all"), F.sum("pos").over(wa).alias("p_all")
                    ).filter(F.col("threshold").isNotNull())
    tp = F.col("flag_pos")
    fp = F.col("flag_n") - F.col("flag_pos")
    fn = F.col("p_all") - F.col("flag_pos")
    tn = F.col("n_all") - F.col("p_all") - fp
    r = r.select("threshold", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), "n_all")
    return r.select(
        "threshold", M.f2().alias("f2"), M.recall().alias("recall"), M.precision().alias("precision"),
        "tp", "fp", "fn", "tn",
        ((F.col("tp") + F.col("fp")) / F.col("n_all") * 100).alias("flagged_pct"),
        (F.col("tp") * tp_cost + F.col("fp") * fp_cost + F.col("fn") * fn_cost).alias("cost"))
