"""Registered scored-table queries (error analysis and deployment analyses) and their SQL twins.

Per-fold decisions (thresholds tuned on training folds) feed the error
analysis; decisions at the mean threshold feed the deployment analysis.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..operators import curves
from ..operators import evaluation as E
from .registry import register
from .scoring import scored_mean_cases, scored_with_thresholds
from .sql_cases import (F2, FPR, PRECISION, RECALL, SCORED, SCORED_MEAN, confusion_sql, pr_auc_sql,
                        unpivot_sql, with_)

RATES = ["f2", "precision", "recall", "fpr"]


def _grid_sql() -> str:
    vals = ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in C.threshold_grid())
    return f"grid AS (SELECT unnest([{vals}]) AS threshold)"


SEGPERF_CTE = (",\nseg AS (" + unpivot_sql("scored", C.SEGMENT_COLS, ["escalated", "y_pred", "y_prob"])
               + "),\ncnt AS (SELECT segment, category, count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, "
               + confusion_sql() + " FROM seg GROUP BY segment, category HAVING sum(escalated) > 0),\n"
               + pr_auc_sql("seg", ["segment", "category"]) + f""",
segperf AS (SELECT c.segment, c.category, n, n_pos, n_pos / n AS prevalence, {F2} AS f2,
  CASE WHEN n_pos >= {C.MIN_POS_PR_AUC} THEN a.pr_auc END AS pr_auc, {PRECISION} AS precision, {RECALL} AS recall,
  {FPR} AS fpr, tp, fp, fn, tn
FROM cnt c LEFT JOIN auc a ON c.segment = a.segment AND c.category = a.category)""")

SWEEP_CTE = ",\n" + _grid_sql() + f""",
sw_c AS (SELECT g.threshold, count(*) AS n_all,
  CAST(sum(CASE WHEN m.y_prob >= g.threshold AND m.escalated = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN m.y_prob >= g.threshold AND m.escalated = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN m.y_prob < g.threshold AND m.escalated = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN m.y_prob < g.threshold AND m.escalated = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM grid g CROSS JOIN model_cases m GROUP BY g.threshold),
sweep AS (SELECT threshold, {F2} AS f2, {RECALL} AS recall, {PRECISION} AS precision, tp, fp, fn, tn,
  (tp + fp) / n_all * 100 AS flagged_pct, CAST(tp * {C.COST_TP} + fp * {C.COST_FP} + fn * {C.COST_FN} AS BIGINT) AS cost
  FROM sw_c)"""

POOLED_MEAN = f"""pooled AS (SELECT count(*) AS n_all, CAST(sum(escalated) AS BIGINT) AS p_all, {confusion_sql()}
  FROM scored_mean)"""


# ------------------------------------------------------------------ per-fold decisions (error analysis)

@register("segment_performance", ops="D22", doubles=["prevalence", "pr_auc"] + RATES,
          sql=with_(SCORED + SEGPERF_CTE, "SELECT * FROM segperf"))
def q_segment_performance(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.segment_performance(scored)


@register("recall_disparity", ops="D23", doubles=["max_recall", "min_recall", "disparity", "ratio", "min_fpr", "max_fpr"],
          sql=with_(SCORED + SEGPERF_CTE, f"""SELECT segment, count(*) AS n_categories,
  first(category ORDER BY recall DESC, category) AS max_recall_category, max(recall) AS max_recall,
  first(category ORDER BY recall ASC, category) AS min_recall_category, min(recall) AS min_recall,
  max(recall) - min(recall) AS disparity,
  CASE WHEN max(recall) > 0 THEN min(recall) / max(recall) ELSE 0.0 END AS ratio,
  (CASE WHEN max(recall) > 0 THEN min(recall) / max(recall) ELSE 0.0 END) >= {C.FOUR_FIFTHS} AS passes_80_rule,
  first(category ORDER BY fpr ASC, category) AS min_fpr_category, min(fpr) AS min_fpr,
  first(category ORDER BY fpr DESC, category) AS max_fpr_category, max(fpr) AS max_fpr
FROM segperf WHERE segment IN ({", ".join(repr(a) for a in C.FAIRNESS_ATTRS)})
GROUP BY segment HAVING count(*) >= 2"""))
def q_recall_disparity(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.recall_disparity(E.segment_performance(scored))


@register("equalised_odds", ops="D24", doubles=["tpr", "fpr", "ppv", "f2", "tpr_gap", "fpr_gap"],
          sql=with_(SCORED + ",\neo AS (" + unpivot_sql("scored", C.EQUALISED_ODDS_ATTRS, ["escalated", "y_pred"],
                                                        "attribute", '"group"') + f"""),
eo_c AS (SELECT attribute, "group", count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, {confusion_sql()}
  FROM eo GROUP BY attribute, "group"),
eo_r AS (SELECT attribute, "group", n, n_pos, {RECALL} AS tpr, {FPR} AS fpr, {PRECISION} AS ppv, {F2} AS f2,
  tp, fp, fn, tn FROM eo_c),
gaps AS (SELECT attribute, max(tpr) - min(tpr) AS tpr_gap, max(fpr) - min(fpr) AS fpr_gap FROM eo_r GROUP BY attribute)""",
                    f"""SELECT r.*, g.tpr_gap, g.fpr_gap, (g.tpr_gap < {C.TPR_GAP_LIMIT} AND g.fpr_gap < {C.FPR_GAP_LIMIT})
  AS within_limits FROM eo_r r JOIN gaps g ON r.attribute = g.attribute"""))
def q_equalised_odds(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.equalised_odds(scored)


@register("confusion", ops="D19-D21", doubles=["prevalence"] + RATES,
          sql=with_(SCORED + f""",
cf AS (SELECT count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, {confusion_sql()} FROM scored)""",
                    f"""SELECT n, n_pos, tp, fp, fn, tn, {F2} AS f2, {PRECISION} AS precision, {RECALL} AS recall,
  {FPR} AS fpr, CASE WHEN n > 0 THEN n_pos / n ELSE 0.0 END AS prevalence FROM cf"""))
def q_confusion(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.confusion(scored)


@register("f_beta", ops="D20", doubles=["f1", "f2", "f05"],
          sql=with_(SCORED + f""",
cf AS (SELECT fold, {confusion_sql()} FROM scored GROUP BY fold)""",
                    """SELECT fold, tp, fp, fn,
  CASE WHEN 1.0 * (tp + fn) + (tp + fp) > 0 THEN 2.0 * tp / (1.0 * (tp + fn) + (tp + fp)) ELSE 0.0 END AS f1,
  CASE WHEN 4.0 * (tp + fn) + (tp + fp) > 0 THEN 5.0 * tp / (4.0 * (tp + fn) + (tp + fp)) ELSE 0.0 END AS f2,
  CASE WHEN 0.25 * (tp + fn) + (tp + fp) > 0 THEN 1.25 * tp / (0.25 * (tp + fn) + (tp + fp)) ELSE 0.0 END AS f05
FROM cf"""))
def q_f_beta(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    c = scored.groupBy("fold").agg(*M.confusion_aggs())
    return c.select("fold", "tp", "fp", "fn", M.f_beta(beta=1.0).alias("f1"), M.f_beta(beta=2.0).alias("f2"),
                    M.f_beta(beta=0.5).alias("f05"))


PR_CURVE_SQL = with_(SCORED + ",\n" + """pc_h AS (SELECT y_prob AS s, count(*) AS n, sum(escalated) AS pos FROM model_cases GROUP BY y_prob),
pc_c AS (SELECT s,
  CAST(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS tp,
  CAST(sum(n) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS nn,
  CAST(sum(pos) OVER () AS DOUBLE) AS p_tot FROM pc_h),
pc AS (SELECT s AS threshold, CAST(tp AS BIGINT) AS tp, CAST(nn - tp AS BIGINT) AS fp, tp / nn AS precision,
  CASE WHEN p_tot = 0 THEN 1.0 ELSE tp / p_tot END AS recall FROM pc_c)""",
                     """SELECT threshold, tp, fp, precision, recall,
  CASE WHEN precision + recall > 0 THEN 5 * precision * recall / (4 * precision + recall) ELSE 0.0 END AS f2 FROM pc""")


@register("pr_curve", ops="F1", doubles=["threshold", "precision", "recall", "f2"], sql=PR_CURVE_SQL)
def q_pr_curve(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    cv = curves.pr_curve(scored, [])
    return cv.select("threshold", "tp", "fp", "precision", "recall", "f2")


@register("pr_auc", ops="F2", doubles=["pr_auc"],
          sql=with_(SCORED + ",\n" + pr_auc_sql("scored", ["fold"]), "SELECT fold, pr_auc FROM auc"))
def q_pr_auc(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return curves.pr_auc(scored, ["fold"])


@register("best_threshold", ops="F3", doubles=["threshold", "train_f2"],
          sql=with_(SCORED, """SELECT k AS fold, s AS threshold, f2 AS train_f2 FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY f2 DESC, s ASC) AS rn FROM th_f2) WHERE rn = 1"""))
def q_best_threshold(spark, sf_dir):
    _, thr, _ = scored_with_thresholds(spark, sf_dir)
    return thr


@register("oof_predictions", ops="L9,C3", doubles=["y_prob", "threshold"],
          sql=with_(SCORED, "SELECT case_id, customer_id, fold, escalated, y_prob, threshold, y_pred FROM scored"))
def q_oof_predictions(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return scored.select("case_id", "customer_id", "fold", "escalated", "y_prob", "threshold", "y_pred")


_PT = ("CASE WHEN escalated = 1 AND y_pred = 1 THEN 'TP' WHEN escalated = 0 AND y_pred = 1 THEN 'FP' "
       "WHEN escalated = 1 AND y_pred = 0 THEN 'FN' ELSE 'TN' END")


@register("outcome_labels", ops="B14", doubles=["y_prob", "threshold"],
          sql=with_(SCORED, f"SELECT case_id, fold, escalated, y_prob, threshold, y_pred, {_PT} AS prediction_type FROM scored"))
def q_outcome_labels(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.outcome_labels(scored).select("case_id", "fold", "escalated", "y_prob", "threshold", "y_pred",
                                           "prediction_type")


_ERR_COLS = "case_id, customer_id, escalation_level, customer_type, tenure_type, region, issue_category, sentiment, y_prob, fold"


@register("error_rows", ops="A6", doubles=["y_prob"],
          sql=with_(SCORED, f"SELECT {_ERR_COLS}, {_PT} AS prediction_type FROM scored WHERE escalated = 1 AND y_pred = 0"))
def q_error_rows(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.error_rows(scored, "FN")


@register("error_samples", ops="G3", doubles=["y_prob"],
          sql=with_(SCORED, f"""SELECT {_ERR_COLS}, {_PT} AS prediction_type FROM scored
WHERE escalated = 0 AND y_pred = 1 ORDER BY case_id LIMIT 10"""))
def q_error_samples(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.error_samples(scored, "FP", 10)


@register("distribution_shift", ops="C4,D16,H2", doubles=["a_pct", "b_pct", "diff_pts"],
          sql=with_(SCORED + ",\nlab AS (SELECT *, " + _PT + " AS prediction_type FROM scored),\nds AS ("
                    + unpivot_sql("lab", C.SEGMENT_COLS, ["prediction_type"]) + """),
ds_c AS (SELECT segment, category,
  count(*) FILTER (WHERE prediction_type = 'FN') AS fn, count(*) FILTER (WHERE prediction_type = 'TP') AS tp,
  count(*) FILTER (WHERE prediction_type = 'FP') AS fp, count(*) FILTER (WHERE prediction_type = 'TN') AS tn
  FROM ds GROUP BY segment, category),
ds_t AS (SELECT *, sum(fn) OVER (PARTITION BY segment) AS fn_total, sum(tp) OVER (PARTITION BY segment) AS tp_total,
  sum(fp) OVER (PARTITION BY segment) AS fp_total, sum(tn) OVER (PARTITION BY segment) AS tn_total FROM ds_c),
u AS (
  SELECT 'FN_vs_TP' AS comparison, segment, category,
    CASE WHEN fn_total > 0 THEN fn / fn_total ELSE 0.0 END * 100 AS a_pct,
    CASE WHEN tp_total > 0 THEN tp / tp_total ELSE 0.0 END * 100 AS b_pct, """ + str(C.FN_TP_MARK) + """ AS mark_at
  FROM ds_t WHERE fn + tp > 0
  UNION ALL
  SELECT 'FP_vs_TN', segment, category,
    CASE WHEN fp_total > 0 THEN fp / fp_total ELSE 0.0 END * 100,
    CASE WHEN tn_total > 0 THEN tn / tn_total ELSE 0.0 END * 100, """ + str(C.FP_TN_MARK) + """
  FROM ds_t WHERE segment IN ('issue_category', 'sentiment') AND fp + tn > 0)""",
                    """SELECT comparison, segment, category, a_pct, b_pct, a_pct - b_pct AS diff_pts,
  abs(a_pct - b_pct) > mark_at AS marked FROM u"""))
def q_distribution_shift(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.distribution_shift(scored)


@register("prob_by_outcome", ops="D17", doubles=["mean_prob", "median_prob", "min_prob", "max_prob"],
          sql=with_(SCORED, f"""SELECT {_PT} AS prediction_type, count(*) AS n, avg(y_prob) AS mean_prob,
  median(y_prob) AS median_prob, min(y_prob) AS min_prob, max(y_prob) AS max_prob FROM scored GROUP BY 1"""))
def q_prob_by_outcome(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.prob_by_outcome(scored)


@register("close_misses", ops="B24", doubles=["mean_threshold", "close_pct"],
          sql=with_(SCORED + f""",
mt AS (SELECT avg(threshold) AS mean_threshold FROM thr),
fnr AS (SELECT s.y_prob, mt.mean_threshold FROM scored s CROSS JOIN mt WHERE s.escalated = 1 AND s.y_pred = 0)""",
                    f"""SELECT (SELECT mean_threshold FROM mt) AS mean_threshold, count(*) AS n_fn,
  count(*) FILTER (WHERE y_prob >= mean_threshold - {C.CLOSE_MARGIN}) AS n_close,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE y_prob >= mean_threshold - {C.CLOSE_MARGIN}) / count(*) ELSE 0.0 END * 100
  AS close_pct FROM fnr"""))
def q_close_misses(spark, sf_dir):
    scored, _, mt = scored_with_thresholds(spark, sf_dir)
    return E.close_misses(scored, mt())


@register("miss_rate_by_level", ops="D18", doubles=["miss_rate_pct"],
          sql=with_(SCORED, """SELECT escalation_level, count(*) FILTER (WHERE y_pred = 0) AS missed, count(*) AS total,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE y_pred = 0) / count(*) ELSE 0.0 END * 100 AS miss_rate_pct
FROM scored WHERE escalated = 1 GROUP BY escalation_level"""))
def q_miss_rate_by_level(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.miss_rate_by_level(scored)


@register("cost_scenarios", ops="D25", doubles=["reduction_vs_no_model_pct", "reduction_vs_flag_all_pct",
                                                "reviewed_pct", "precision", "recall"],
          sql=with_(SCORED + f""",
cf AS (SELECT count(*) AS n, {confusion_sql()} FROM scored),
cs AS (SELECT n, tp, fp, fn, tn,
  CAST(tp * {C.COST_TP} + fp * {C.COST_FP} + fn * {C.COST_FN} + tn * {C.COST_TN} AS BIGINT) AS model_cost,
  CAST((tp + fn) * {C.COST_FN} AS BIGINT) AS no_model_cost,
  CAST((tp + fn) * {C.COST_TP} + (fp + tn) * {C.COST_FP} AS BIGINT) AS flag_all_cost,
  CAST((tp + fn) * {C.COST_TP} AS BIGINT) AS perfect_cost, CAST(tp + fp AS BIGINT) AS emails_reviewed FROM cf)""",
                    f"""SELECT *, no_model_cost - model_cost AS savings_vs_no_model, flag_all_cost - model_cost AS savings_vs_flag_all,
  CASE WHEN no_model_cost > 0 THEN (no_model_cost - model_cost) / no_model_cost ELSE 0.0 END * 100 AS reduction_vs_no_model_pct,
  CASE WHEN flag_all_cost > 0 THEN (flag_all_cost - model_cost) / flag_all_cost ELSE 0.0 END * 100 AS reduction_vs_flag_all_pct,
  emails_reviewed / n * 100 AS reviewed_pct, {PRECISION} AS precision, {RECALL} AS recall FROM cs"""))
def q_cost_scenarios(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.cost_scenarios(scored)


def _bin_sql(x: str = "y_prob", edges=C.CALIBRATION_EDGES) -> tuple[str, str]:
    idx, lab = [], []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{x} >= {lo} AND {x} <= {hi}" if i == 0 else f"{x} > {lo} AND {x} <= {hi}"
        label = f"[{lo}, {hi}]" if i == 0 else f"({lo}, {hi}]"
        idx.append(f"WHEN {cond} THEN {i}")
        lab.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(idx) + " END", "CASE " + " ".join(lab) + " END"


@register("calibration_table", ops="B17,D26", doubles=["mean_prob", "actual_rate"],
          sql=with_(SCORED + f""",
cb AS (SELECT {_bin_sql()[0]} AS bin, {_bin_sql()[1]} AS prob_bin, escalated, y_prob FROM scored)""",
                    """SELECT bin, prob_bin, count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, avg(y_prob) AS mean_prob,
  sum(escalated) / count(*) AS actual_rate FROM cb WHERE bin IS NOT NULL GROUP BY bin, prob_bin"""))
def q_calibration_table(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.calibration_table(scored)


@register("fold_metrics", ops="L1,D19", doubles=["f2", "pr_auc", "precision", "recall", "threshold"],
          sql=with_(SCORED + f""",
fc AS (SELECT fold, count(*) AS n_val, CAST(sum(escalated) AS BIGINT) AS n_pos_val, {confusion_sql()},
  first(threshold) AS threshold FROM scored GROUP BY fold),
""" + pr_auc_sql("scored", ["fold"]), f"""SELECT f.fold, {F2} AS f2, a.pr_auc, {PRECISION} AS precision, {RECALL} AS recall,
  tn, fp, fn, tp, n_val, n_pos_val, threshold FROM fc f JOIN auc a ON f.fold = a.fold"""))
def q_fold_metrics(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.fold_metrics(scored)


@register("fold_aggregate", ops="D30,B25", doubles=["mean", "std", "min", "max"],
          sql=with_(SCORED + f""",
fc AS (SELECT fold, {confusion_sql()} FROM scored GROUP BY fold),
""" + pr_auc_sql("scored", ["fold"]) + f""",
fm AS (SELECT f.fold, {F2} AS f2, a.pr_auc, {PRECISION} AS precision, {RECALL} AS recall FROM fc f JOIN auc a ON f.fold = a.fold),
lg AS (SELECT 'f2' AS metric, f2 AS v FROM fm UNION ALL SELECT 'pr_auc', pr_auc FROM fm
       UNION ALL SELECT 'precision', precision FROM fm UNION ALL SELECT 'recall', recall FROM fm),
ag AS (SELECT metric, count(*) AS n_folds, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max
       FROM lg GROUP BY metric)""", "SELECT *, printf('%.4f (+/-%.4f)', mean, std) AS summary FROM ag"))
def q_fold_aggregate(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.fold_aggregate(E.fold_metrics(scored))


@register("dummy_f2", ops="D30,D31", doubles=["all_negative_f2", "all_positive_f2", "class_ratio"],
          sql=with_(SCORED + """,
t AS (SELECT count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos FROM model_cases)""",
                    """SELECT n, n_pos, 0.0 AS all_negative_f2,
  CASE WHEN 4.0 * n_pos + n > 0 THEN 5.0 * n_pos / (4.0 * n_pos + n) ELSE 0.0 END AS all_positive_f2,
  CASE WHEN n_pos > 0 THEN (n - n_pos) / n_pos ELSE 0.0 END AS class_ratio FROM t"""))
def q_dummy_f2(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.dummy_f2(scored)


# ------------------------------------------------------------------ mean-threshold decisions (deployment)

@register("oof_predictions_mean", ops="L10", doubles=["y_prob", "threshold"],
          sql=with_(SCORED_MEAN, "SELECT case_id, fold, escalated, y_prob, threshold, y_pred FROM scored_mean"))
def q_oof_predictions_mean(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return s.select("case_id", "fold", "escalated", "y_prob", "threshold", "y_pred")


@register("threshold_sweep", ops="F6,C6", doubles=["threshold", "f2", "recall", "precision", "flagged_pct"],
          sql=with_(SCORED + SWEEP_CTE, "SELECT * FROM sweep"))
def q_threshold_sweep(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return curves.threshold_sweep(s)


@register("threshold_picks", ops="F6,D33", doubles=["threshold", "f2", "recall", "precision", "flagged_pct"],
          sql=with_(SCORED + SWEEP_CTE + """,
pk AS (SELECT first(threshold ORDER BY f2 DESC, threshold) AS best_f2,
  first(threshold ORDER BY cost, threshold) AS lowest_cost,
  first(threshold ORDER BY abs(flagged_pct - 30.0), threshold) AS workload FROM sweep),
pl AS (SELECT 'best_f2' AS pick, best_f2 AS threshold FROM pk UNION ALL SELECT 'lowest_cost', lowest_cost FROM pk
       UNION ALL SELECT 'workload_30', workload FROM pk)""",
                    """SELECT pl.pick, s.threshold, s.f2, s.recall, s.precision, s.flagged_pct, s.cost
FROM pl JOIN sweep s ON pl.threshold = s.threshold"""))
def q_threshold_picks(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.threshold_picks(curves.threshold_sweep(s))


@register("tier_distribution", ops="B16,D28", doubles=["pct", "prevalence", "catch_pct"],
          sql=with_(SCORED_MEAN + f""",
tr AS (SELECT CASE WHEN y_prob >= {C.TIER_HIGH} THEN 'HIGH' WHEN y_prob >= threshold THEN 'MEDIUM' ELSE 'LOW' END AS tier,
  escalated FROM scored_mean),
tiers AS (SELECT * FROM (VALUES ('HIGH', 1), ('MEDIUM', 2), ('LOW', 3)) v(tier, tier_order)),
tg AS (SELECT t.tier, t.tier_order, count(r.tier) AS n, CAST(coalesce(sum(r.escalated), 0) AS BIGINT) AS n_escalated
  FROM tiers t LEFT JOIN tr r ON t.tier = r.tier GROUP BY t.tier, t.tier_order),
tt AS (SELECT *, sum(n) OVER () AS n_all, sum(n_escalated) OVER () AS p_all FROM tg)""",
                    """SELECT tier, tier_order, n, CASE WHEN n_all > 0 THEN n / n_all ELSE 0.0 END * 100 AS pct, n_escalated,
  CASE WHEN n > 0 THEN n_escalated / n ELSE 0.0 END * 100 AS prevalence,
  CASE WHEN p_all > 0 THEN n_escalated / p_all ELSE 0.0 END * 100 AS catch_pct FROM tt"""))
def q_tier_distribution(spark, sf_dir):
    s, mt = scored_mean_cases(spark, sf_dir)
    return E.tier_distribution(s, mt)


_TEMPORAL_CTE = f""",
tq AS (SELECT CAST(year(ts) AS VARCHAR) || 'Q' || CAST(quarter(ts) AS VARCHAR) AS period, count(*) AS n,
  CAST(sum(escalated) AS BIGINT) AS n_pos, avg(y_prob) AS mean_prob, {confusion_sql()} FROM scored_mean GROUP BY 1
  HAVING sum(escalated) >= {C.MIN_POS_QUARTER}),
temporal AS (SELECT period, n, n_pos, n_pos / n * 100 AS prevalence, {F2} AS f2, {RECALL} AS recall, mean_prob FROM tq)"""


@register("temporal_stability", ops="B4,D27", doubles=["prevalence", "f2", "recall", "mean_prob"],
          sql=with_(SCORED_MEAN + _TEMPORAL_CTE, "SELECT * FROM temporal"))
def q_temporal_stability(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.temporal_stability(s)


@register("stability_summary", ops="D27", doubles=["f2_std", "recall_std", "prevalence_std"],
          sql=with_(SCORED_MEAN + _TEMPORAL_CTE, f"""SELECT count(*) AS n_periods, stddev_samp(f2) AS f2_std,
  stddev_samp(recall) AS recall_std, stddev_samp(prevalence) AS prevalence_std,
  (stddev_samp(f2) < {C.STABLE_F2_STD} AND stddev_samp(prevalence) < {C.STABLE_PREV_STD}) AS stable FROM temporal"""))
def q_stability_summary(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.stability_summary(E.temporal_stability(s))


@register("cost_sensitivity", ops="C7,D29", doubles=["optimal_threshold"],
          sql=with_(SCORED_MEAN + SWEEP_CTE + ",\n" + POOLED_MEAN + f""",
fnc AS (SELECT unnest({C.FN_COST_GRID}) AS fn_cost),
opt AS (SELECT f.fn_cost, first(s.threshold ORDER BY s.tp * {C.COST_TP} + s.fp * {C.COST_FP} + s.fn * f.fn_cost, s.threshold)
  AS optimal_threshold, CAST(min(s.tp * {C.COST_TP} + s.fp * {C.COST_FP} + s.fn * f.fn_cost) AS BIGINT) AS optimal_cost
  FROM fnc f CROSS JOIN sweep s GROUP BY f.fn_cost)""",
                    f"""SELECT o.fn_cost, CAST(p.tp * {C.COST_TP} + p.fp * {C.COST_FP} + p.fn * o.fn_cost AS BIGINT) AS model_cost,
  CAST(p.p_all * {C.COST_TP} + (p.n_all - p.p_all) * {C.COST_FP} AS BIGINT) AS flag_all_cost,
  CAST(p.p_all * o.fn_cost AS BIGINT) AS no_model_cost, o.optimal_threshold, o.optimal_cost,
  (p.tp * {C.COST_TP} + p.fp * {C.COST_FP} + p.fn * o.fn_cost) < (p.p_all * {C.COST_TP} + (p.n_all - p.p_all) * {C.COST_FP})
  AS model_beats_flag_all FROM opt o CROSS JOIN pooled p"""))
def q_cost_sensitivity(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.cost_sensitivity(s, curves.threshold_sweep(s))


@register("cost_breakeven", ops="D29", doubles=["crossover_fn_cost", "breakeven_tested", "breakeven_fine", "breakeven_fn_cost"],
          sql=with_(SCORED_MEAN + ",\n" + POOLED_MEAN + f""",
pb AS (SELECT tp, fp, fn, CAST(p_all * {C.COST_TP} + (n_all - p_all) * {C.COST_FP} AS BIGINT) AS flag_all_cost,
  tp * {C.COST_TP} + fp * {C.COST_FP} AS base FROM pooled),
bt AS (SELECT min(c) AS breakeven_tested FROM pb, unnest({C.FN_COST_GRID}) AS t(c) WHERE base + fn * c < flag_all_cost),
bf AS (SELECT min(c) AS breakeven_fine FROM pb, range({C.BREAKEVEN_FALLBACK[0]}, {C.BREAKEVEN_FALLBACK[1]}, {C.BREAKEVEN_FALLBACK[2]}) AS t(c)
  WHERE base + fn * c < flag_all_cost)""",
                    """SELECT tp, fp, fn, flag_all_cost, CAST(breakeven_tested AS DOUBLE) AS breakeven_tested,
  CAST(breakeven_fine AS DOUBLE) AS breakeven_fine,
  CAST(coalesce(breakeven_tested, breakeven_fine) AS DOUBLE) AS breakeven_fn_cost,
  CASE WHEN fn > 0 THEN (flag_all_cost - base) / fn END AS crossover_fn_cost FROM pb, bt, bf"""))
def q_cost_breakeven(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.cost_breakeven(s)


@register("monitoring_snapshot", ops="D32", doubles=["flag_rate_pct", "mean_prob", "high_risk_rate_pct"],
          sql=with_(SCORED_MEAN, f"""SELECT count(*) AS n, avg(CAST(y_pred AS DOUBLE)) * 100 AS flag_rate_pct,
  avg(y_prob) AS mean_prob, avg(CASE WHEN y_prob >= {C.TIER_HIGH} THEN 1.0 ELSE 0.0 END) * 100 AS high_risk_rate_pct
FROM scored_mean"""))
def q_monitoring_snapshot(spark, sf_dir):
    s, _ = scored_mean_cases(spark, sf_dir)
    return E.monitoring_snapshot(s)
