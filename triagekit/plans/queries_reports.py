"""Report tables behind the figures (P1-P8) and run summaries (Q1-Q5).

Each report is a filter / re-shape of an analysis query; summaries are
one-row frames of scalars (flat for checking, nested structs for the JSON sink).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..operators import evaluation as E
from ..operators import profiling as PF
from ..operators import stats as ST
from ..sources.cases import cases, prepare
from ..sources.tables import read_table
from .queries_eval import _TEMPORAL_CTE, POOLED_MEAN
from .registry import register
from .scoring import scored_mean_cases, scored_with_thresholds
from .sql_cases import CASES, F2, PRECISION, RECALL, SCORED, SCORED_MEAN, confusion_sql, with_


@register("report_rate_by_region", ops="P2", doubles=["escalation_rate"],
          sql=with_(CASES, """SELECT region AS value, count(*) AS n, avg(CAST(escalated AS DOUBLE)) AS escalation_rate
FROM cases GROUP BY region"""))
def q_report_rate_by_region(spark, sf_dir):
    r = PF.category_rates(cases(spark, sf_dir), ["region"])
    return r.select("value", "n", "escalation_rate")


@register("report_outcome_histograms", ops="P5,D34",
          sql=with_(SCORED + """,
lab AS (SELECT CASE WHEN escalated = 1 AND y_pred = 1 THEN 'TP' WHEN escalated = 0 AND y_pred = 1 THEN 'FP'
  WHEN escalated = 1 AND y_pred = 0 THEN 'FN' ELSE 'TN' END AS prediction_type, y_prob FROM scored)""",
                    """SELECT prediction_type, CAST(least(floor(y_prob * 20) + 1, 20) AS INTEGER) AS bin, count(*) AS n
FROM lab GROUP BY ALL"""))
def q_report_outcome_histograms(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    lab = E.outcome_labels(scored)
    b = F.least(F.floor(F.col("y_prob") * 20) + 1, F.lit(20)).cast("int")
    return lab.groupBy("prediction_type", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("report_calibration_points", ops="P6", doubles=["mean_prob", "actual_rate"],
          sql=with_(SCORED + """,
cb AS (SELECT CASE WHEN y_prob >= 0.0 AND y_prob <= 0.2 THEN 0 WHEN y_prob > 0.2 AND y_prob <= 0.3 THEN 1
  WHEN y_prob > 0.3 AND y_prob <= 0.4 THEN 2 WHEN y_prob > 0.4 AND y_prob <= 0.5 THEN 3
  WHEN y_prob > 0.5 AND y_prob <= 0.6 THEN 4 WHEN y_prob > 0.6 AND y_prob <= 0.7 THEN 5
  WHEN y_prob > 0.7 AND y_prob <= 0.8 THEN 6 WHEN y_prob > 0.8 AND y_prob <= 1.0 THEN 7 END AS bin, escalated, y_prob FROM scored)""",
                    """SELECT bin, count(*) AS n, avg(y_prob) AS mean_prob, sum(escalated) / count(*) AS actual_rate
FROM cb WHERE bin IS NOT NULL GROUP BY bin HAVING count(*) >= 10"""))
def q_report_calibration_points(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return E.calibration_table(scored).filter(F.col("n") >= 10).select("bin", "n", "mean_prob", "actual_rate")


@register("report_tier_stack", ops="P8",
          sql=with_(SCORED_MEAN + f""",
tr AS (SELECT CASE WHEN y_prob >= {C.TIER_HIGH} THEN 'HIGH' WHEN y_prob >= threshold THEN 'MEDIUM' ELSE 'LOW' END AS tier,
  escalated FROM scored_mean)""",
                    """SELECT tier, count(*) FILTER (WHERE escalated = 1) AS n_escalated,
  count(*) FILTER (WHERE escalated = 0) AS n_not_escalated FROM tr GROUP BY tier"""))
def q_report_tier_stack(spark, sf_dir):
    s, mt = scored_mean_cases(spark, sf_dir)
    t = s.select(M.risk_tier("y_prob", mt).alias("tier"), "escalated")
    return t.groupBy("tier").agg(F.count_if(F.col("escalated") == 1).alias("n_escalated"),
                                 F.count_if(F.col("escalated") == 0).alias("n_not_escalated"))


@register("report_fold_distribution", ops="P4", doubles=["min", "q1", "median", "q3", "max"],
          sql=with_(SCORED + f""",
fc AS (SELECT fold, {confusion_sql()} FROM scored GROUP BY fold),
fm AS (SELECT fold, {F2} AS f2 FROM fc)""",
                    """SELECT 'f2' AS metric, min(f2) AS min, quantile_cont(f2, 0.25) AS q1, quantile_cont(f2, 0.5) AS median,
  quantile_cont(f2, 0.75) AS q3, max(f2) AS max FROM fm"""))
def q_report_fold_distribution(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    fm = E.confusion(scored, ["fold"]).select("fold", "f2")
    q = PF.exact_quantiles(fm, "f2", [0.25, 0.5, 0.75])
    qq = {r["q"]: r["value"] for r in q.collect()}  # three values
    return fm.agg(F.min("f2").alias("min"), F.max("f2").alias("max")).select(
        F.lit("f2").alias("metric"), "min", F.lit(qq[0.25]).alias("q1"), F.lit(qq[0.5]).alias("median"),
        F.lit(qq[0.75]).alias("q3"), "max")


# ------------------------------------------------------------------------------------- run summaries

_ES_SQL = with_(SCORED + f""",
cf AS (SELECT count(*) AS n, {confusion_sql()} FROM scored),
ml AS (SELECT escalation_level, count(*) FILTER (WHERE y_pred = 0) / count(*) * 100 AS mr FROM scored
       WHERE escalated = 1 GROUP BY escalation_level),
mt AS (SELECT avg(threshold) AS mean_threshold FROM thr),
cl AS (SELECT count(*) AS n_close FROM scored, mt WHERE escalated = 1 AND y_pred = 0 AND y_prob >= mean_threshold - {C.CLOSE_MARGIN})""",
                f"""SELECT {F2} AS f2, {RECALL} AS recall, {PRECISION} AS precision, tp, fp, fn, tn, n,
  (SELECT mean_threshold FROM mt) AS mean_threshold, (SELECT n_close FROM cl) AS n_close_fn,
  (SELECT mr FROM ml WHERE escalation_level = 2) AS miss_rate_level_2, (SELECT mr FROM ml WHERE escalation_level = 3) AS miss_rate_level_3,
  CAST((tp + fn) * {C.COST_FN} AS BIGINT) AS cost_no_model,
  CAST((tp + fn) * {C.COST_TP} + (fp + tn) * {C.COST_FP} AS BIGINT) AS cost_flag_all,
  CAST(tp * {C.COST_TP} + fp * {C.COST_FP} + fn * {C.COST_FN} AS BIGINT) AS cost_model,
  CAST((tp + fn) * {C.COST_TP} AS BIGINT) AS cost_perfect FROM cf""")


@register("error_summary", ops="Q4,D18,D19,D25",
          doubles=["f2", "recall", "precision", "mean_threshold", "miss_rate_level_2", "miss_rate_level_3"], sql=_ES_SQL)
def q_error_summary(spark, sf_dir):
    scored, _, mt = scored_with_thresholds(spark, sf_dir)
    mean = mt()
    c = E.confusion(scored)
    mr = {r["escalation_level"]: r["miss_rate_pct"] for r in E.miss_rate_by_level(scored).collect()}  # few levels
    close = E.close_misses(scored, mean).first()["n_close"]
    return c.select(
        "f2", "recall", "precision", "tp", "fp", "fn", "tn", "n", F.lit(mean).alias("mean_threshold"),
        F.lit(int(close)).cast("long").alias("n_close_fn"),
        F.lit(mr.get(2)).cast("double").alias("miss_rate_level_2"), F.lit(mr.get(3)).cast("double").alias("miss_rate_level_3"),
        ((F.col("tp") + F.col("fn")) * C.COST_FN).alias("cost_no_model"),
        ((F.col("tp") + F.col("fn")) * C.COST_TP + (F.col("fp") + F.col("tn")) * C.COST_FP).alias("cost_flag_all"),
        (F.col("tp") * C.COST_TP + F.col("fp") * C.COST_FP + F.col("fn") * C.COST_FN).alias("cost_model"),
        ((F.col("tp") + F.col("fn")) * C.COST_TP).alias("cost_perfect"))


_FS_SQL = with_(SCORED_MEAN + _TEMPORAL_CTE + ",\n" + POOLED_MEAN + f""",
tiers AS (SELECT count(*) FILTER (WHERE y_prob >= {C.TIER_HIGH}) AS n_high,
  count(*) FILTER (WHERE y_prob >= threshold AND y_prob < {C.TIER_HIGH}) AS n_medium,
  count(*) FILTER (WHERE y_prob < threshold) AS n_low, avg(CAST(y_pred AS DOUBLE)) * 100 AS flag_rate_pct,
  avg(y_prob) AS mean_prob, avg(CASE WHEN y_prob >= {C.TIER_HIGH} THEN 1.0 ELSE 0.0 END) * 100 AS high_risk_rate_pct,
  max(threshold) AS mean_threshold FROM scored_mean),
st AS (SELECT stddev_samp(f2) AS f2_std, stddev_samp(prevalence) AS prev_std FROM temporal)""",
                f"""SELECT t.mean_threshold, {F2} AS f2,
  CASE WHEN p.tp + p.fn > 0 THEN p.tp / (p.tp + p.fn) ELSE 0.0 END AS recall,
  CASE WHEN p.tp + p.fp > 0 THEN p.tp / (p.tp + p.fp) ELSE 0.0 END AS precision,
  t.n_high, t.n_medium, t.n_low,
  CAST(p.tp * {C.COST_TP} + p.fp * {C.COST_FP} + p.fn * {C.COST_FN} AS BIGINT) AS cost_model,
  st.f2_std AS f2_std_quarters, (st.f2_std < {C.STABLE_F2_STD} AND st.prev_std < {C.STABLE_PREV_STD}) AS stable,
  t.flag_rate_pct, t.mean_prob, t.high_risk_rate_pct FROM tiers t, pooled p, st""")


@register("final_summary", ops="Q5,L10,D27,D28,D32",
          doubles=["mean_threshold", "f2", "recall", "precision", "f2_std_quarters", "flag_rate_pct", "mean_prob",
                   "high_risk_rate_pct"], sql=_FS_SQL)
def q_final_summary(spark, sf_dir):
    s, mt = scored_mean_cases(spark, sf_dir)
    c = E.confusion(s)
    tiers = s.agg(F.count_if(F.col("y_prob") >= C.TIER_HIGH).alias("n_high"),
                  F.count_if((F.col("y_prob") >= mt) & (F.col("y_prob") < C.TIER_HIGH)).alias("n_medium"),
                  F.count_if(F.col("y_prob") < mt).alias("n_low")).first()
    stab = E.stability_summary(E.temporal_stability(s)).first()
    mon = E.monitoring_snapshot(s).first()
    return c.select(
        F.lit(mt).alias("mean_threshold"), "f2", "recall", "precision",
        F.lit(tiers["n_high"]).cast("long").alias("n_high"), F.lit(tiers["n_medium"]).cast("long").alias("n_medium"),
        F.lit(tiers["n_low"]).cast("long").alias("n_low"),
        (F.col("tp") * C.COST_TP + F.col("fp") * C.COST_FP + F.col("fn") * C.COST_FN).alias("cost_model"),
        F.lit(stab["f2_std"]).alias("f2_std_quarters"), F.lit(bool(stab["stable"])).alias("stable"),
        F.lit(mon["flag_rate_pct"]).alias("flag_rate_pct"), F.lit(mon["mean_prob"]).alias("mean_prob"),
        F.lit(mon["high_risk_rate_pct"]).alias("high_risk_rate_pct"))


def _feature_summary_sql() -> str:
    from .queries_profile import _CORR_SQL, _CV_BODY, _CV_LONG, _chi_sql, _vif_ctes, LINE_NUMERICS
    from .sql_cases import MODEL
    ctes = MODEL + ",\n" + _chi_sql(_CV_LONG) + ",\ncv AS (" + _CV_BODY + "),\n" + _CORR_SQL + ",\n" + _vif_ctes(LINE_NUMERICS)
    return with_(ctes, """SELECT (SELECT first(col_a ORDER BY abs(r) DESC) FROM cr) AS corr_a,
  (SELECT first(col_b ORDER BY abs(r) DESC) FROM cr) AS corr_b, (SELECT max(abs(r)) FROM cr) AS max_abs_r,
  (SELECT first(feature_1 ORDER BY cramers_v DESC, feature_1, feature_2) FROM cv) AS cramers_a,
  (SELECT first(feature_2 ORDER BY cramers_v DESC, feature_1, feature_2) FROM cv) AS cramers_b,
  (SELECT max(cramers_v) FROM cv) AS max_cramers_v,
  (SELECT first(feature ORDER BY vif DESC) FROM vf) AS vif_feature, (SELECT max(vif) FROM vf) AS max_vif""")


@register("feature_summary", ops="Q1,E5,E6,E7", doubles=["max_abs_r", "max_cramers_v", "max_vif"],
          sql=_feature_summary_sql())
def q_feature_summary(spark, sf_dir):
    from .queries_profile import LINE_NUMERICS
    li = read_table(spark, sf_dir, "lineitem")
    mc = ST.max_correlation(ST.correlations(li, LINE_NUMERICS)).first()
    cv = ST.cramers_v(prepare(cases(spark, sf_dir)))
    top = cv.orderBy(F.col("cramers_v").desc(), "feature_1", "feature_2").first()
    vif = ST.vif(li, LINE_NUMERICS).orderBy(F.col("vif").desc()).first()
    return spark.createDataFrame([(mc["col_a"], mc["col_b"], float(mc["max_abs_r"]), top["feature_1"], top["feature_2"],
                                   float(top["cramers_v"]), vif["feature"], float(vif["vif"]))],
                                 "corr_a string, corr_b string, max_abs_r double, cramers_a string, cramers_b string, "
                                 "max_cramers_v double, vif_feature string, max_vif double")


@register("run_summary", ops="Q4,Q5,A5")
def q_run_summary(spark, sf_dir):
    es = q_error_summary(spark, sf_dir)
    fs = q_final_summary(spark, sf_dir)
    fsd = fs.first().asDict()  # one row
    return es.select(F.struct(*es.columns).alias("error_analysis"),
                     F.struct(*[F.lit(v).alias(k) for k, v in fsd.items()]).alias("deployment"))


@register("ranked_features", ops="F5,G1,G2", doubles=["escalation_rate"],
          sql=with_(CASES + ",\nlg AS (" + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, escalated FROM cases" for c in C.PROFILE_CAT_COLS) + """),
g AS (SELECT "column", value, count(*) AS n, avg(CAST(escalated AS DOUBLE)) AS escalation_rate FROM lg GROUP BY ALL)""",
                    """SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY escalation_rate DESC, value NULLS LAST) AS INTEGER) AS rank FROM g"""))
def q_ranked_features(spark, sf_dir):
    from pyspark.sql import Window
    r = PF.category_rates(cases(spark, sf_dir), C.PROFILE_CAT_COLS)
    w = Window.partitionBy("column").orderBy(F.col("escalation_rate").desc(), F.col("value").asc_nulls_last())
    return r.withColumn("rank", F.row_number().over(w))  # one row per (column, value)


_RULES = {"tuned_per_fold": "y_pred", "default_0_5": "CAST(y_prob >= 0.5 AS INTEGER)",
          "mean_threshold": "CAST(y_prob >= (SELECT avg(threshold) FROM thr) AS INTEGER)"}


@register("comparison_table", ops="B25,D30,L5", doubles=["mean_f2", "std_f2"],
          sql=with_(SCORED + ",\n" + ",\n".join(
              f"c_{r} AS (SELECT '{r}' AS rule, fold, {confusion_sql(pred=e)} FROM scored GROUP BY fold)" for r, e in _RULES.items())
              + ",\nu AS (" + " UNION ALL ".join(f"SELECT rule, fold, {F2} AS f2 FROM c_{r}" for r in _RULES) + ")",
              """SELECT rule, avg(f2) AS mean_f2, stddev_samp(f2) AS std_f2,
  printf('%.4f (+/-%.4f)', avg(f2), stddev_samp(f2)) AS summary FROM u GROUP BY rule"""))
def q_comparison_table(spark, sf_dir):
    scored, _, mt = scored_with_thresholds(spark, sf_dir)
    rules = {"tuned_per_fold": F.col("y_pred"), "default_0_5": M.apply_threshold("y_prob", 0.5),
             "mean_threshold": M.apply_threshold("y_prob", mt())}
    parts = []
    for name, e in rules.items():
        c = scored.withColumn("_p", e).groupBy("fold").agg(*M.confusion_aggs(pred="_p"))
        parts.append(c.select(F.lit(name).alias("rule"), "fold", M.f2().alias("f2")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    g = u.groupBy("rule").agg(F.avg("f2").alias("mean_f2"), F.stddev_samp("f2").alias("std_f2"))
    return g.withColumn("summary", M.mean_std_text("mean_f2", "std_f2"))


@register("report_tables", ops="P1,D2,D12,D36", doubles=["value"],
          sql=with_(CASES + """,
tot AS (SELECT count(*) AS n_all FROM cases),
p AS (
  SELECT 'target' AS panel, CAST(escalated AS VARCHAR) AS key, count(*) AS n,
         count(*) / (SELECT n_all FROM tot) * 100 AS value FROM cases GROUP BY escalated
  UNION ALL SELECT 'rate_by_sentiment', sentiment, count(*), avg(CAST(escalated AS DOUBLE)) FROM cases GROUP BY sentiment
  UNION ALL SELECT 'rate_by_issue', issue_category, count(*), avg(CAST(escalated AS DOUBLE)) FROM cases GROUP BY issue_category
  UNION ALL SELECT 'missing_by_class', CAST(escalated AS VARCHAR), count(*),
         avg(CASE WHEN sentiment IS NULL THEN 1.0 ELSE 0.0 END) * 100 FROM cases GROUP BY escalated)""",
                    "SELECT * FROM p"))
def q_report_tables(spark, sf_dir):
    """EDA overview panels in long form: target shares, rates by sentiment / issue, missingness by class."""
    c = cases(spark, sf_dir)
    t = PF.target_distribution(c).select(F.lit("target").alias("panel"), F.col("escalated").cast("string").alias("key"),
                                         "n", F.col("pct").alias("value"))
    r = PF.category_rates(c, ["sentiment", "issue_category"]).select(
        F.when(F.col("column") == "sentiment", "rate_by_sentiment").otherwise("rate_by_issue").alias("panel"),
        F.col("value").alias("key"), "n", F.col("escalation_rate").alias("value"))
    m = c.groupBy("escalated").agg(F.count(F.lit(1)).alias("n"),
                                   (F.avg(F.col("sentiment").isNull().cast("double")) * 100).alias("value")).select(
        F.lit("missing_by_class").alias("panel"), F.col("escalated").cast("string").alias("key"), "n", "value")
    return t.unionByName(r).unionByName(m)
