"""Scored-table metrics.

Input is a *scored table*: one row per case with ``escalated`` (0/1 label),
``y_prob`` (score), ``y_pred`` (0/1 decision) and segment columns. Every
function is a relational aggregate over it: rows are reduced map-side to
small per-key counts before any shuffle, so a hot segment value only costs a
partial aggregate per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions import metrics as M
from . import curves


def _rates(df: DataFrame) -> list:
    return [M.f2().alias("f2"), M.precision().alias("precision"), M.recall().alias("recall"),
            M.fpr().alias("fpr")]


def confusion(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Confusion counts and derived rates, pooled or per key."""
    keys = list(keys or [])
    agg = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.col("escalated").cast("long")).alias("n_pos"),
                                    *M.confusion_aggs())
    return agg.select(*keys, "n", "n_pos", "tp", "fp", "fn", "tn", *_rates(agg),
                      M.safe_div("n_pos", "n").alias("prevalence"))


def unpivot_segments(scored: DataFrame, segment_cols: list[str], extra: list[str]) -> DataFrame:
    """(segment, category, extra...) long form: one row per case and segment column."""
    ids = list(extra)
    return scored.select(*ids, *[F.col(c).cast("string").alias(c) for c in segment_cols]).unpivot(
        ids, segment_cols, "segment", "category")


def segment_performance(scored: DataFrame, segment_cols: list[str] = C.SEGMENT_COLS,
                        min_pos_auc: int = C.MIN_POS_PR_AUC) -> DataFrame:
    """Per segment value: n, positives, prevalence, F2, PR-AUC, precision, recall, FPR, counts.

    Segments without positives are skipped; PR-AUC needs ``min_pos_auc`` positives.
    """
    long = unpivot_segments(scored, segment_cols, ["escalated", "y_pred", "y_prob"])
    keys = ["segment", "category"]
    counts = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("escalated").cast("long")).alias("n_pos"),
                                     *M.confusion_aggs()).filter(F.col("n_pos") > 0)
    auc = curves.pr_auc(long, keys)
    j = counts.join(auc, keys, "left")
    return j.select(
        "segment", "category", "n", "n_pos", (F.col("n_pos") / F.col("n")).alias("prevalence"),
        M.f2().alias("f2"),
        F.when(F.col("n_pos") >= min_pos_auc, F.col("pr_auc")).alias("pr_auc"),
        M.precision().alias("precision"), M.recall().alias("recall"), M.fpr().alias("fpr"),
        "tp", "fp", "fn", "tn")


def recall_disparity(seg: DataFrame, attrs: list[str] = C.FAIRNESS_ATTRS) -> DataFrame:
    """Highest/lowest recall value per attribute, disparity, min/max ratio, 80% rule, FPR range.

    Ties pick the alphabetically first category.
    """
    s = seg.filter(F.col("segment").isin(attrs))
    hi = F.min_by("category", F.struct((-F.col("recall")).alias("a"), F.col("category").alias("b")))
    lo = F.min_by("category", F.struct(F.col("recall").alias("a"), F.col("category").alias("b")))
    fhi = F.min_by("category", F.struct((-F.col("fpr")).alias("a"), F.col("category").alias("b")))
    flo = F.min_by("category", F.struct(F.col("fpr").alias("a"), F.col("category").alias("b")))
    g = s.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_categories"),
        hi.alias("max_recall_category"), F.max("recall").alias("max_recall"),
        lo.alias("min_recall_category"), F.min("recall").alias("min_recall"),
        flo.alias("min_fpr_category"), F.min("fpr").alias("min_fpr"),
        fhi.alias("max_fpr_category"), F.max("fpr").alias("max_fpr")).filter(F.col("n_categories") >= 2)
    ratio = M.safe_div("min_recall", "max_recall")
    return g.select("segment", "n_categories", "max_recall_category", "max_recall", "min_recall_category",
                    "min_recall", (F.col("max_recall") - F.col("min_recall")).alias("disparity"),
                    ratio.alias("ratio"), (ratio >= C.FOUR_FIFTHS).alias("passes_80_rule"),
                    "min_fpr_category", "min_fpr", "max_fpr_category", "max_fpr")


def equalised_odds(scored: DataFrame, attrs: list[str] = C.EQUALISED_ODDS_ATTRS) -> DataFrame:
    """TPR, FPR, PPV, F2 per attribute value, with per-attribute gaps and verdict."""
    long = unpivot_segments(scored, attrs, ["escalated", "y_pred"]).withColumnRenamed(
        "segment", "attribute").withColumnRenamed("category", "group")
    g = long.groupBy("attribute", "group").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum(F.col("escalated").cast("long")).alias("n_pos"),
                                               *M.confusion_aggs())
    g = g.select("attribute", "group", "n", "n_pos", M.recall().alias("tpr"), M.fpr().alias("fpr"),
                 M.precision().alias("ppv"), M.f2().alias("f2"), "tp", "fp", "fn", "tn")
    gaps = g.groupBy("attribute").agg((F.max("tpr") - F.min("tpr")).alias("tpr_gap"),
                                      (F.max("fpr") - F.min("fpr")).alias("fpr_gap"))
    gaps = gaps.withColumn("within_limits", (F.col("tpr_gap") < C.TPR_GAP_LIMIT) &
                           (F.col("fpr_gap") < C.FPR_GAP_LIMIT))
    return g.join(gaps, "attribute")


def cost_scenarios(scored: DataFrame, fn_cost: int = C.COST_FN, fp_cost: int = C.COST_FP,
                   tp_cost: int = C.COST_TP, tn_cost: int = C.COST_TN) -> DataFrame:
    """Model vs no model vs flag-all vs perfect cost, savings, workload."""
    c = confusion(scored)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    model = tp * tp_cost + fp * fp_cost + fn * fn_cost + tn * tn_cost
    none = (tp + fn) * fn_cost
    flag_all = (tp + fn) * tp_cost + (fp + tn) * fp_cost
    perfect = (tp + fn) * tp_cost
    r = c.select("n", "tp", "fp", "fn", "tn", model.alias("model_cost"), none.alias("no_model_cost"),
                 flag_all.alias("flag_all_cost"), perfect.alias("perfect_cost"),
                 (tp + fp).alias("emails_reviewed"))
    return r.select("*",
                    (F.col("no_model_cost") - F.col("model_cost")).alias("savings_vs_no_model"),
                    (F.col("flag_all_cost") - F.col("model_cost")).alias("savings_vs_flag_all"),
                    (M.safe_div(F.col("no_model_cost") - F.col("model_cost"), "no_model_cost") * 100)
                    .alias("reduction_vs_no_model_pct"),
                    (M.safe_div(F.col("flag_all_cost") - F.col("model_cost"), "flag_all_cost") * 100)
                    .alias("reduction_vs_flag_all_pct"),
                    (F.col("emails_reviewed") / F.col("n") * 100).alias("reviewed_pct"),
                    M.precision().alias("precision"), M.recall().alias("recall"))


def calibration_table(scored: DataFrame, edges: list[float] = C.CALIBRATION_EDGES) -> DataFrame:
    """Per right-closed probability bin: n, positives, mean score, actual rate."""
    b = scored.select(M.right_closed_bin_index("y_prob", edges).alias("bin"),
                      M.right_closed_bin("y_prob", edges).alias("prob_bin"), "escalated", "y_prob")
    g = b.filter(F.col("bin").isNotNull()).groupBy("bin", "prob_bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_pos"),
        F.avg("y_prob").alias("mean_prob"))
    return g.select("bin", "prob_bin", "n", "n_pos", "mean_prob", (F.col("n_pos") / F.col("n")).alias("actual_rate"))


def temporal_stability(scored: DataFrame, ts_col: str = "ts", min_pos: int = C.MIN_POS_QUARTER) -> DataFrame:
    """Per quarter: n, positives, prevalence %, F2, recall, mean score; quarters under ``min_pos`` skipped."""
    g = scored.groupBy(cal.quarter_label(ts_col).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_pos"),
        F.avg("y_prob").alias("mean_prob"), *M.confusion_aggs())
    g = g.filter(F.col("n_pos") >= min_pos)
    return g.select("period", "n", "n_pos", (F.col("n_pos") / F.col("n") * 100).alias("prevalence"),
                    M.f2().alias("f2"), M.recall().alias("recall"), "mean_prob")


def stability_summary(temp: DataFrame) -> DataFrame:
    """Std (n-1) of F2, recall and prevalence across periods; stable verdict."""
    s = temp.agg(F.count(F.lit(1)).alias("n_periods"), F.stddev_samp("f2").alias("f2_std"),
                 F.stddev_samp("recall").alias("recall_std"), F.stddev_samp("prevalence").alias("prevalence_std"))
    return s.withColumn("stable", (F.col("f2_std") < C.STABLE_F2_STD) & (F.col("prevalence_std") < C.STABLE_PREV_STD))


def tier_distribution(scored: DataFrame, mean_thresh, high: float = C.TIER_HIGH) -> DataFrame:
    """HIGH / MEDIUM / LOW tiers: n, %, escalations, prevalence %, share of escalations."""
    t = scored.select(M.risk_tier("y_prob", mean_thresh, high).alias("tier"), "escalated")
    g = t.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_escalated"))
    spark = scored.sparkSession
    tiers = spark.createDataFrame([("HIGH", 1), ("MEDIUM", 2), ("LOW", 3)], "tier string, tier_order int")
    j = F.broadcast(tiers).join(g, "tier", "left").fillna(0, subset=["n", "n_escalated"])
    wa = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # 3 rows
    j = j.select("tier", "tier_order", "n", "n_escalated", F.sum("n").over(wa).alias("n_all"),
                 F.sum("n_escalated").over(wa).alias("p_all"))
    return j.select("tier", "tier_order", "n", (M.safe_div("n", "n_all") * 100).alias("pct"), "n_escalated",
                    (M.safe_div("n_escalated", "n") * 100).alias("prevalence"),
                    (M.safe_div("n_escalated", "p_all") * 100).alias("catch_pct"))


def threshold_picks(sweep: DataFrame, workload_pct: float = 30.0) -> DataFrame:
    """Best-F2, lowest-cost and nearest-to-workload rows of a sweep (D33); ties -> lowest threshold."""
    pick_f2 = F.min_by("threshold", F.struct((-F.col("f2")).alias("a"), F.col("threshold").alias("b")))
    pick_cost = F.min_by("threshold", F.struct(F.col("cost").alias("a"), F.col("threshold").alias("b")))
    pick_wl = F.min_by("threshold", F.struct(F.abs(F.col("flagged_pct") - workload_pct).alias("a"),
                                             F.col("threshold").alias("b")))
    p = sweep.agg(pick_f2.alias("best_f2"), pick_cost.alias("lowest_cost"), pick_wl.alias("workload"))
    long = p.select(F.expr("stack(3, 'best_f2', best_f2, 'lowest_cost', lowest_cost, "
                           "'workload_30', workload) as (pick, threshold)"))
    return long.join(sweep, "threshold").select("pick", "threshold", "f2", "recall", "precision",
                                                "flagged_pct", "cost")


def cost_sensitivity(scored: DataFrame, sweep: DataFrame, fn_costs: list[int] = C.FN_COST_GRID,
                     fp_cost: int = C.COST_FP, tp_cost: int = C.COST_TP) -> DataFrame:
    """Per FN cost: model / flag-all / no-model cost, cost-optimal sweep threshold, model-wins flag."""
    pooled = scored.agg(F.count(F.lit(1)).alias("N"), F.sum(F.col("escalated").cast("long")).alias("P"),
                        *M.confusion_aggs())
    grid = F.explode(F.array(*[F.lit(int(c)) for c in fn_costs])).alias("fn_cost")
    sw = sweep.select("threshold", "tp", "fp", "fn", grid)
    sw = sw.withColumn("t_cost", F.col("tp") * tp_cost + F.col("fp") * fp_cost + F.col("fn") * F.col("fn_cost"))
    opt = sw.groupBy("fn_cost").agg(
        F.min_by("threshold", F.struct(F.col("t_cost").alias("a"), F.col("threshold").alias("b"))).alias("optimal_threshold"),
        F.min("t_cost").alias("optimal_cost"))
    pc = pooled.select("N", "P", "tp", "fp", "fn", grid)
    model = F.col("tp") * tp_cost + F.col("fp") * fp_cost + F.col("fn") * F.col("fn_cost")
    flag_all = F.col("P") * tp_cost + (F.col("N") - F.col("P")) * fp_cost
    pc = pc.select("fn_cost", model.alias("model_cost"), flag_all.alias("flag_all_cost"),
                   (F.col("P") * F.col("fn_cost")).alias("no_model_cost"))
    j = pc.join(opt, "fn_cost")
    return j.select("fn_cost", "model_cost", "flag_all_cost", "no_model_cost", "optimal_threshold",
                    "optimal_cost", (F.col("model_cost") < F.col("flag_all_cost")).alias("model_beats_flag_all"))


def cost_breakeven(scored: DataFrame, fn_costs: list[int] = C.FN_COST_GRID,
                   fallback=C.BREAKEVEN_FALLBACK, fp_cost: int = C.COST_FP, tp_cost: int = C.COST_TP) -> DataFrame:
    """Lowest tested FN cost where the model beats flag-all, fine-grid fallback, exact crossover."""
    lo, hi, step = fallback
    pooled = scored.agg(F.count(F.lit(1)).alias("N"), F.sum(F.col("escalated").cast("long")).alias("P"),
                        *M.confusion_aggs())
    flag_all = F.col("P") * tp_cost + (F.col("N") - F.col("P")) * fp_cost
    base = F.col("tp") * tp_cost + F.col("fp") * fp_cost
    coarse = F.array(*[F.lit(int(c)) for c in fn_costs])
    fine = F.sequence(F.lit(lo), F.lit(hi - 1), F.lit(step))
    wins = lambda arr: F.array_min(F.filter(arr, lambda c: base + F.col("fn") * c < flag_all))
    r = pooled.select("tp", "fp", "fn", flag_all.alias("flag_all_cost"),
                      wins(coarse).alias("breakeven_tested"), wins(fine).alias("breakeven_fine"),
                      F.when(F.col("fn") > 0, (flag_all - base) / F.col("fn")).alias("crossover_fn_cost"))
    # nullable results are doubles so a missing breakeven is NaN/NULL alike everywhere
    return r.select("tp", "fp", "fn", "flag_all_cost", F.col("breakeven_tested").cast("double").alias("breakeven_tested"),
                    F.col("breakeven_fine").cast("double").alias("breakeven_fine"),
                    F.coalesce("breakeven_tested", "breakeven_fine").cast("double").alias("breakeven_fn_cost"),
                    "crossover_fn_cost")


def monitoring_snapshot(scored: DataFrame, high: float = C.TIER_HIGH) -> DataFrame:
    """Current flag rate %, mean score, HIGH-tier rate %."""
    return scored.agg(F.count(F.lit(1)).alias("n"),
                      (F.avg(F.col("y_pred").cast("double")) * 100).alias("flag_rate_pct"),
                      F.avg("y_prob").alias("mean_prob"),
                      (F.avg((F.col("y_prob") >= high).cast("double")) * 100).alias("high_risk_rate_pct"))


def outcome_labels(scored: DataFrame) -> DataFrame:
    """Adds TP / FP / FN / TN per row."""
    return scored.withColumn("prediction_type", M.prediction_type())


def distribution_shift(scored: DataFrame) -> DataFrame:
    """Category shares of FN vs TP (all segments, mark > 10 points) and FP vs TN
    (issue_category, sentiment; mark > 5 points) over the union of categories (C4, D16, H2)."""
    lab = outcome_labels(scored)
    long = unpivot_segments(lab, C.SEGMENT_COLS, ["prediction_type"])
    g = long.groupBy("segment", "category").agg(
        F.count_if(F.col("prediction_type") == "FN").alias("fn"), F.count_if(F.col("prediction_type") == "TP").alias("tp"),
        F.count_if(F.col("prediction_type") == "FP").alias("fp"), F.count_if(F.col("prediction_type") == "TN").alias("tn"))
    w = Window.partitionBy("segment")  # per-segment category table, already aggregated
    g = g.select("*", *[F.sum(c).over(w).alias(f"{c}_total") for c in ("fn", "tp", "fp", "tn")])
    a = g.filter((F.col("fn") + F.col("tp")) > 0).select(
        F.lit("FN_vs_TP").alias("comparison"), "segment", "category",
        (M.safe_div("fn", "fn_total") * 100).alias("a_pct"), (M.safe_div("tp", "tp_total") * 100).alias("b_pct"),
        F.lit(C.FN_TP_MARK).alias("mark_at"))
    b = g.filter(F.col("segment").isin("issue_category", "sentiment") & ((F.col("fp") + F.col("tn")) > 0)).select(
        F.lit("FP_vs_TN").alias("comparison"), "segment", "category",
        (M.safe_div("fp", "fp_total") * 100).alias("a_pct"), (M.safe_div("tn", "tn_total") * 100).alias("b_pct"),
        F.lit(C.FP_TN_MARK).alias("mark_at"))
    u = a.unionByName(b)
    d = F.col("a_pct") - F.col("b_pct")
    return u.select("comparison", "segment", "category", "a_pct", "b_pct", d.alias("diff_pts"),
                    (F.abs(d) > F.col("mark_at")).alias("marked"))


def prob_by_outcome(scored: DataFrame) -> DataFrame:
    """Score mean / median / min / max per outcome type."""
    from .profiling import exact_quantiles
    lab = outcome_labels(scored)
    base = lab.groupBy("prediction_type").agg(F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_prob"),
                                              F.min("y_prob").alias("min_prob"), F.max("y_prob").alias("max_prob"))
    mid = exact_quantiles(lab, "y_prob", [0.5], ["prediction_type"])
    # at most four rows a side
    return base.join(mid.select("prediction_type", F.col("value").alias("median_prob")), "prediction_type", "left")


def close_misses(scored: DataFrame, mean_thresh, margin: float = C.CLOSE_MARGIN) -> DataFrame:
    """Missed positives scoring within ``margin`` below the mean threshold."""
    mt = mean_thresh if hasattr(mean_thresh, "alias") else F.lit(float(mean_thresh))
    fn = scored.filter((F.col("escalated") == 1) & (F.col("y_pred") == 0))
    r = fn.agg(F.count(F.lit(1)).alias("n_fn"), F.count_if(F.col("y_prob") >= mt - margin).alias("n_close"))
    return r.select(mt.alias("mean_threshold"), "n_fn", "n_close",
                    (M.safe_div("n_close", "n_fn") * 100).alias("close_pct"))


def miss_rate_by_level(scored: DataFrame, level_col: str = "escalation_level") -> DataFrame:
    """Missed / total positives and miss rate % per escalation level."""
    pos = scored.filter(F.col("escalated") == 1)
    g = pos.groupBy(level_col).agg(F.count_if(F.col("y_pred") == 0).alias("missed"),
                                   F.count(F.lit(1)).alias("total"))
    return g.select(level_col, "missed", "total", (M.safe_div("missed", "total") * 100).alias("miss_rate_pct"))


def error_rows(scored: DataFrame, kind: str = "FN",
               cols=("case_id", "customer_id", "escalation_level", "customer_type", "tenure_type",
                     "region", "issue_category", "sentiment", "y_prob", "fold")) -> DataFrame:
    """Projection of all rows of one outcome type."""
    lab = outcome_labels(scored).filter(F.col("prediction_type") == kind)
    return lab.select(*[c for c in cols if c in lab.columns], "prediction_type")


def error_samples(scored: DataFrame, kind: str = "FN", k: int = 10, order_col: str = "case_id") -> DataFrame:
    """First ``k`` rows of one outcome in a stable order (G3): a top-k report."""
    return error_rows(scored, kind).orderBy(order_col).limit(k)


def fold_metrics(scored: DataFrame, fold: str = "fold") -> DataFrame:
    """Per validation fold: F2, PR-AUC, precision, recall, counts, threshold (L1/L2 result table)."""
    c = confusion(scored, [fold])
    auc = curves.pr_auc(scored, [fold])
    j = c.join(auc, fold)
    cols = [fold, "f2", "pr_auc", "precision", "recall", "tn", "fp", "fn", "tp",
            F.col("n").alias("n_val"), F.col("n_pos").alias("n_pos_val")]
    if "threshold" in scored.columns:
        th = scored.groupBy(fold).agg(F.first("threshold").alias("threshold"))
        return j.join(th, fold).select(*cols, "threshold")
    return j.select(*cols)


def fold_aggregate(fm: DataFrame, metrics=("f2", "pr_auc", "precision", "recall")) -> DataFrame:
    """Mean, sample std, min, max per metric across folds, plus 'mean (+/-std)' text."""
    long = fm.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v"))
                                          for m in metrics])).alias("x")).select("x.metric", "x.v")
    g = long.groupBy("metric").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("v").alias("mean"),
                                   F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    return g.withColumn("summary", M.mean_std_text("mean", "std"))


def dummy_f2(scored: DataFrame) -> DataFrame:
    """F2 of the all-negative and all-positive classifiers, and the class ratio."""
    r = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_pos"))
    P, N = F.col("n_pos"), F.col("n")
    return r.select("n", "n_pos", F.lit(0.0).alias("all_negative_f2"),
                    M.f_beta(P, N - P, F.lit(0)).alias("all_positive_f2"),
                    M.safe_div(N - P, P).alias("class_ratio"))
