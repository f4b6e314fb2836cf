"""Registered feature, split, model and interpretation queries.

Relational ones (vocabulary, weights, one-hot, scaling, fixture folds,
stratified folds, exact kNN votes, representative rows) carry DuckDB SQL;
model-fitting studies are rows-only checks.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..functions.text import clean_text
from ..operators import features as FE
from ..operators import interpret as IN
from ..operators import models as MD
from ..operators import splits as SP
from ..session import cut_lineage
from ..sources.cases import cases, prepare
from ..sources.tables import read_table
from . import cv as CV
from . import studies as S
from .registry import register
from .scoring import scored_with_thresholds
from .sql_cases import CASES, MODEL, SCORED, with_

_CLEAN_SQL = "trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_TERMS_CTE = f"""cl AS (SELECT doc_id, {_CLEAN_SQL} AS tc FROM documents),
tk AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(tc)), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM cl),
tb AS (SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms FROM tk),
ex AS (SELECT doc_id, unnest(terms) AS term FROM tb),
pd AS (SELECT doc_id, term, count(*) AS c FROM ex GROUP BY doc_id, term),
st AS (SELECT term, count(*) AS df, CAST(sum(c) AS BIGINT) AS tf FROM pd GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
kept AS (SELECT st.* FROM st, nd WHERE df >= {C.TFIDF_MIN_DF} AND df <= {C.TFIDF_MAX_DF} * n ORDER BY tf DESC, term LIMIT {C.TFIDF_MAX_FEATURES}),
vocab AS (SELECT term, df, tf, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf,
  CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS "index" FROM kept, nd)"""


def _docs_clean(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_text("text").alias(C.TEXT_COL_CLEAN))


def _model_cases(spark, sf_dir):
    return prepare(cases(spark, sf_dir))


# Rows in a partition of the text cases.
STUDY_ROWS = 5_000


def _case_prep():
    return FE.Preprocessor(text_col=None)


def _study_cases(spark, sf_dir):
    """Labelled text case table of the model studies: text, categories, numbers, target and customer-disjoint folds."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", F.col("toxic").alias("escalated"))
    t = SP.assign_group_folds(d.join(lab, "doc_id").withColumnRenamed("source", "customer_id"))
    # few bytes a row, much arithmetic: partitions follow cores and rows, not bytes
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-lab.count() // STUDY_ROWS))
    t = t.repartition(parts).select(
        F.col("doc_id").alias("case_id"), "customer_id", "lang",
        F.col("quality").cast("string").alias("quality"), F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"), "escalated", "fold",
        clean_text("text").alias(C.TEXT_COL_CLEAN))
    # cleaned and folded text and the folds are computed once and shared by all fits, folds and configurations
    return cut_lineage(FE.normalized_text(t, C.TEXT_COL_CLEAN, "_text_norm").drop(C.TEXT_COL_CLEAN))


def _study_prep(text="_text_norm", cats=("lang", "quality"), nums=("n_chars", "n_words"), **spec):
    return FE.Preprocessor(text, list(cats), list(nums), FE.pre_normalized(FE.TfidfSpec(**spec)))


# --------------------------------------------------------------------------------------- features

@register("tfidf_vocabulary", ops="I1,I2", doubles=["idf"], sql=with_(_TERMS_CTE, "SELECT * FROM vocab"))
def q_tfidf_vocabulary(spark, sf_dir):
    return FE.tfidf_vocabulary(_docs_clean(spark, sf_dir), C.TEXT_COL_CLEAN, FE.TfidfSpec(), "doc_id")


@register("tfidf_weights", ops="I1", doubles=["weight"],
          sql=with_(_TERMS_CTE + """,
cw AS (SELECT pd.doc_id, pd.term, (1 + ln(pd.c)) * v.idf AS w FROM pd JOIN vocab v ON pd.term = v.term),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM cw GROUP BY doc_id)""",
                    "SELECT cw.doc_id, cw.term, cw.w / nr.nrm AS weight FROM cw JOIN nr ON cw.doc_id = nr.doc_id"))
def q_tfidf_weights(spark, sf_dir):
    d = _docs_clean(spark, sf_dir)
    vocab = FE.tfidf_vocabulary(d, C.TEXT_COL_CLEAN, FE.TfidfSpec(), "doc_id")
    return FE.tfidf_long(d, "doc_id", C.TEXT_COL_CLEAN, vocab)


def _unpivot_cats(src: str, where: str) -> str:
    return " UNION ALL ".join(f"SELECT case_id, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM {src} WHERE {where}"
                              for c in C.CATEGORICAL_COLS)


_FOLDS = "folds AS (SELECT DISTINCT fold AS k FROM model_cases)"


@register("onehot_encode", ops="I3",
          sql=with_(MODEL + f""",
{_FOLDS},
cats AS ({" UNION ALL ".join(f"SELECT case_id, fold, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM model_cases" for c in C.CATEGORICAL_COLS)}),
d AS (SELECT DISTINCT k, col, v FROM cats JOIN folds ON fold <> k WHERE v IS NOT NULL),
f AS (SELECT k, col, min(v) AS first_v FROM d GROUP BY k, col),
keep AS (SELECT d.k, d.col, d.v FROM d JOIN f ON d.k = f.k AND d.col = f.col WHERE d.v <> f.first_v)""",
                    "SELECT c.case_id, c.fold, c.col || '_' || c.v AS feature FROM cats c JOIN keep ON c.fold = keep.k AND c.col = keep.col AND c.v = keep.v"))
def q_onehot_encode(spark, sf_dir):
    """Indicators of every validation fold, encoded with the other folds' categories."""
    m = _model_cases(spark, sf_dir)
    long = m.select("case_id", "fold", *[F.col(c).cast("string").alias(c) for c in C.CATEGORICAL_COLS]).unpivot(
        ["case_id", "fold"], C.CATEGORICAL_COLS, "column", "value").where("value is not null")
    kept = []
    for k in range(C.N_FOLDS):
        oh = FE.OneHotModel.fit(m.filter(F.col("fold") != k), C.CATEGORICAL_COLS)
        kept += [(k, c, v) for c, vals in oh.categories.items() for v in vals[1:]]
    kt = spark.createDataFrame(kept, "fold int, column string, value string")  # bounded by category counts
    return long.join(F.broadcast(kt), ["fold", "column", "value"]).select(
        "case_id", "fold", F.concat_ws("_", "column", "value").alias("feature"))


@register("standard_scale", ops="I4", doubles=["value"],
          sql=with_(MODEL + f""",
{_FOLDS},
x AS ({" UNION ALL ".join(f"SELECT case_id, fold, '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM model_cases" for c in C.NUMERIC_COLS)}),
st AS (SELECT k, col, avg(x) AS m, stddev_pop(x) AS s FROM x JOIN folds ON fold <> k GROUP BY k, col)""",
                    "SELECT x.case_id, x.fold, x.col AS feature, (x - m) / (CASE WHEN s > 0 THEN s ELSE 1.0 END) AS value FROM x JOIN st ON x.col = st.col AND x.fold = st.k"))
def q_standard_scale(spark, sf_dir):
    """Scaled numbers of every validation fold, with the other folds' means and deviations."""
    m = _model_cases(spark, sf_dir)
    out = None
    for k in range(C.N_FOLDS):
        sc = FE.ScalerModel.fit(m.filter(F.col("fold") != k), C.NUMERIC_COLS)
        va = m.filter(F.col("fold") == k).select("case_id", "fold", *[e.alias(n) for n, e in sc.columns()])
        out = va if out is None else out.unionByName(va)
    return out.unpivot(["case_id", "fold"], C.NUMERIC_COLS, "feature", "value")


# --------------------------------------------------------------------------------------- splits

@register("group_folds", ops="J1")
def q_group_folds(spark, sf_dir):
    return SP.group_folds(cases(spark, sf_dir))


@register("group_fold_balance", ops="J1,H1")
def q_group_fold_balance(spark, sf_dir):
    c = SP.assign_group_folds(cases(spark, sf_dir))
    bal = c.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg("escalated").alias("prevalence"),
                                F.countDistinct("customer_id").alias("n_groups"))
    ov = SP.fold_overlap(c)
    return bal.withColumn("n_overlapping", F.lit(int(ov.first()["n_overlapping"])))  # one scalar


@register("group_fold_sizes", ops="J1",
          sql=with_(CASES, """SELECT CAST(k AS INTEGER) AS fold, CAST((n - k + 4) // 5 AS BIGINT) AS n_groups
FROM (SELECT count(DISTINCT customer_id) AS n FROM cases), range(5) AS r(k)"""))
def q_group_fold_sizes(spark, sf_dir):
    """Groups per dealt fold: dealing in turn fixes the sizes whatever the hash order."""
    return SP.group_folds(cases(spark, sf_dir)).groupBy("fold").agg(F.count(F.lit(1)).alias("n_groups"))


@register("fold_overlap", ops="H1",
          sql=with_(CASES, """SELECT count(*) AS n_groups, count(*) FILTER (WHERE k > 1) AS n_overlapping
FROM (SELECT customer_id, count(DISTINCT fold) AS k FROM cases GROUP BY customer_id)"""))
def q_fold_overlap(spark, sf_dir):
    return SP.fold_overlap(cases(spark, sf_dir))


@register("stratified_folds", ops="J2",
          sql=with_(CASES, """SELECT case_id, escalated,
  CAST((row_number() OVER (PARTITION BY escalated ORDER BY case_id) - 1) % 5 AS INTEGER) AS fold FROM cases"""))
def q_stratified_folds(spark, sf_dir):
    return SP.stratified_folds(cases(spark, sf_dir).select("case_id", "escalated"), "case_id")


@register("smote_rows", ops="J3")
def q_smote_rows(spark, sf_dir):
    m = _model_cases(spark, sf_dir)
    train = m.filter(F.col("fold") != 0)
    fp = _case_prep().fit(train)
    x = fp.transform(train).select(F.col("case_id").cast("string").alias("case_id"), "escalated",
                                   vector_to_array("features").alias("vec"))
    out = SP.smote(x, "case_id", "escalated", "vec")
    return out.select("case_id", "escalated", "synthetic", F.size("vec").alias("dims"),
                      F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v).alias("sq_norm"))


@register("smote_counts", ops="J3",
          sql=with_(MODEL, """SELECT escalated, synthetic, n FROM (
  SELECT escalated, false AS synthetic, count(*) AS n FROM model_cases WHERE fold <> 0 GROUP BY escalated
  UNION ALL
  SELECT first(escalated ORDER BY n, escalated), true, max(n) - min(n) FROM (
    SELECT escalated, count(*) AS n FROM model_cases WHERE fold <> 0 GROUP BY escalated)) WHERE n > 0"""))
def q_smote_counts(spark, sf_dir):
    """Rows per class and origin after resampling: the classes are even."""
    return q_smote_rows(spark, sf_dir).groupBy("escalated", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@register("knn_vote", ops="K6",
          doubles=["vote_share"],
          sql="""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS q, b.vec_id AS p, b.label AS pl,
  list_reduce(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])), lambda x, y: x + y) AS d2
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT q, pl, row_number() OVER (PARTITION BY q ORDER BY d2, p) AS rk FROM pairs),
vt AS (SELECT q, pl, count(*) AS c FROM r WHERE rk <= 5 GROUP BY q, pl),
best AS (SELECT q, first(pl ORDER BY c DESC, pl) AS predicted_label, max(c) AS votes FROM vt GROUP BY q)
SELECT b.q AS vec_id, e.label, b.predicted_label, b.votes / 5.0 AS vote_share FROM best b JOIN e ON e.vec_id = b.q""")
def q_knn_vote(spark, sf_dir):
    return S.knn_vote(read_table(spark, sf_dir, "embeddings"), 5)


# --------------------------------------------------------------------------------------- models

@register("lr_cv", ops="K1,L1,L2")
def q_lr_cv(spark, sf_dir):
    return S.lr_cv(_model_cases(spark, sf_dir), _case_prep())


def _oof(spark, sf_dir, mode="per_fold"):
    """Case rows with the out-of-fold scores and decisions of the logistic baseline, and its fold metrics."""
    m = _model_cases(spark, sf_dir)
    scored, fm = CV.oof_scored(m, MD.reference_models()[0], _case_prep(), mode=mode)
    return CV.with_case_columns(scored, m), fm


@register("oof_model_predictions", ops="L9,C3,H1")
def q_oof_model_predictions(spark, sf_dir):
    """Out-of-fold score of the fitted model, the fold's threshold and the decision on every case."""
    return _oof(spark, sf_dir)[0].select("case_id", "fold", "customer_id", "region", "issue_category", "escalated", "y_prob",
                                         "threshold", "y_pred")


@register("oof_model_rows", ops="L9,C3",
          sql=with_(MODEL, """SELECT fold, region, count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, count(*) AS n_scored
FROM model_cases GROUP BY fold, region"""))
def q_oof_model_rows(spark, sf_dir):
    """Cases, positives and rows with a probability per fold and region: the scores scatter back to every case once."""
    return _oof(spark, sf_dir)[0].groupBy("fold", "region").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_pos"),
        F.count_if(F.col("y_prob").between(0, 1)).alias("n_scored"))


@register("oof_model_segments", ops="L10,L11,D22,D23")
def q_oof_model_segments(spark, sf_dir):
    """Recall, precision and F2 by region and customer type at the mean threshold, from the fitted model's scores."""
    rows = _oof(spark, sf_dir, mode="mean")[0]
    cells = rows.groupBy("region", "customer_type").agg(*M.confusion_aggs())
    segments = F.array(*[F.struct(F.lit(c).alias("segment"), F.col(c).cast("string").alias("value"))
                         for c in ("region", "customer_type")])
    per = cells.withColumn("_s", F.explode(segments)).groupBy("_s").agg(
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])
    return per.select("_s.segment", "_s.value", "tn", "fp", "fn", "tp", M.recall().alias("recall"),
                      M.precision().alias("precision"), M.f2().alias("f2"))


@register("model_comparison", ops="K1-K5,L2,L3,L5,J3")
def q_model_comparison(spark, sf_dir):
    """All six models with one base (LR_baseline) and one selection; XGB_tuned is the best of the grid."""
    cases_ = _study_cases(spark, sf_dir)
    best = S.grid_search(cases_, _study_prep()).where("rank = 1").first()
    tuned = MD.ModelSpec("XGB_tuned", "gbt", {k: best[k] for k in ("n_estimators", "max_depth", "learning_rate")}, "pos")
    return S.compare_models(cases_, _study_prep(), MD.reference_models() + [tuned])


@register("boosted_comparison", ops="K3,K5,L2,L5")
def q_boosted_comparison(spark, sf_dir):
    """The boosted models next to LR_baseline, the base of the paired tests."""
    specs = [s for s in MD.reference_models() if s.kind == "gbt" or s.name == "LR_baseline"]
    return S.compare_models(_study_cases(spark, sf_dir), _study_prep(), specs)


@register("tuned_folds", ops="L4")
def q_tuned_folds(spark, sf_dir):
    """Per-fold metrics of the best grid configuration."""
    cases_ = _study_cases(spark, sf_dir)
    best = S.grid_search(cases_, _study_prep()).where("rank = 1").first()
    spec = MD.ModelSpec("XGB_tuned", "gbt", {k: best[k] for k in ("n_estimators", "max_depth", "learning_rate")}, "pos")
    return CV.cv_fold_metrics(CV.cv_scores(cases_, [spec], _study_prep()))


@register("cluster_profile", ops="K10")
def q_cluster_profile(spark, sf_dir):
    """Size and escalation rate per cluster at the k of the best silhouette."""
    cases_ = _study_cases(spark, sf_dir)
    k = S.kmeans_study(cases_, _study_prep()).where("rank = 1").first()["k"]
    return S.cluster_profile(cases_, _study_prep(), k)


@register("grid_search", ops="L3,L4")
def q_grid_search(spark, sf_dir):
    return S.grid_search(_study_cases(spark, sf_dir), _study_prep())


@register("regularisation_study", ops="K7")
def q_regularisation_study(spark, sf_dir):
    return S.regularisation_study(_study_cases(spark, sf_dir), _study_prep())


@register("ols_baseline", ops="K8,E8")
def q_ols_baseline(spark, sf_dir):
    return S.ols_baseline(_study_cases(spark, sf_dir), _study_prep())


@register("knn_study", ops="K6")
def q_knn_study(spark, sf_dir):
    return S.knn_study(_study_cases(spark, sf_dir), _study_prep())


@register("pca_study", ops="K9")
def q_pca_study(spark, sf_dir):
    return S.pca_study(_study_cases(spark, sf_dir), _study_prep())


@register("explained_variance", ops="F4,I6")
def q_explained_variance(spark, sf_dir):
    return S.explained_variance(_study_cases(spark, sf_dir), _study_prep())


@register("kmeans_study", ops="K10,K11")
def q_kmeans_study(spark, sf_dir):
    return S.kmeans_study(_study_cases(spark, sf_dir), _study_prep())


@register("silhouette", ops="K11,J4")
def q_silhouette(spark, sf_dir):
    t = S.kmeans_study(_study_cases(spark, sf_dir), _study_prep(), ks=[2])
    return t.select("k", "silhouette_sq_euclidean")


@register("feature_ablation", ops="L6,I2,I5")
def q_feature_ablation(spark, sf_dir):
    return S.feature_ablation(_study_cases(spark, sf_dir), {
        "full": _study_prep(),
        "structured_only": _study_prep(text=None),
        "no_numeric": _study_prep(nums=()),
        "text_only": _study_prep(cats=(), nums=()),
        "unigrams": _study_prep(ngram_max=1),
        "tfidf_200": _study_prep(max_features=200),
        "tfidf_1000": _study_prep(max_features=1000),
    })


@register("drop_feature_ablation", ops="L7")
def q_drop_feature_ablation(spark, sf_dir):
    return S.drop_feature_ablation(_study_cases(spark, sf_dir), _study_prep(), "quality")


@register("learning_curve", ops="L8,J2")
def q_learning_curve(spark, sf_dir):
    return S.learning_curve(_study_cases(spark, sf_dir), _study_prep())


@register("representative_fold", ops="L12,C5")
def q_representative_fold(spark, sf_dir):
    return S.fold_coefficients(_study_cases(spark, sf_dir), _study_prep(), 0)


@register("coefficient_importance", ops="M1,B18,B23,G2")
def q_coefficient_importance(spark, sf_dir):
    return IN.coefficient_importance(S.fold_coefficients(_study_cases(spark, sf_dir), _study_prep(), 0))


@register("feature_blocks", ops="B19")
def q_feature_blocks(spark, sf_dir):
    return IN.feature_blocks(S.fold_coefficients(_study_cases(spark, sf_dir), _study_prep(), 0))


@register("permutation_importance", ops="M2,J5,O2")
def q_permutation_importance(spark, sf_dir):
    return S.fold_permutation_importance(_study_cases(spark, sf_dir), _study_prep(), 0)


@register("row_contributions", ops="M3")
def q_row_contributions(spark, sf_dir):
    return S.fold_row_contributions(_study_cases(spark, sf_dir), _study_prep(), 0)


@register("local_surrogates", ops="M3,G4")
def q_local_surrogates(spark, sf_dir):
    """Local linear weights of the representative validation rows of fold 0."""
    return S.fold_local_weights(_study_cases(spark, sf_dir), _study_prep(), 0)


_REP_SQL = with_(SCORED + """,
lab AS (SELECT case_id, y_prob, escalated, CASE WHEN escalated = 1 AND y_pred = 1 THEN 'TP' WHEN escalated = 0 AND y_pred = 1 THEN 'FP'
  WHEN escalated = 1 AND y_pred = 0 THEN 'FN' ELSE 'TN' END AS prediction_type FROM scored),
ext AS (SELECT prediction_type, first(case_id ORDER BY y_prob DESC, case_id) AS hi, first(case_id ORDER BY y_prob, case_id) AS lo,
  count(*) AS n FROM lab GROUP BY prediction_type),
tpr AS (SELECT case_id, row_number() OVER (ORDER BY y_prob DESC, case_id) - 1 AS pos FROM lab WHERE prediction_type = 'TP'),
picks AS (
  SELECT 'TP' AS prediction_type, 'highest' AS pick, hi AS case_id FROM ext WHERE prediction_type = 'TP' UNION ALL
  SELECT 'FN', 'highest', hi FROM ext WHERE prediction_type = 'FN' UNION ALL
  SELECT 'FN', 'lowest', lo FROM ext WHERE prediction_type = 'FN' AND n > 1 UNION ALL
  SELECT 'FP', 'highest', hi FROM ext WHERE prediction_type = 'FP' UNION ALL
  SELECT 'TP', 'median', t.case_id FROM tpr t, ext e WHERE e.prediction_type = 'TP' AND e.n > 1 AND t.pos = e.n // 2)""",
                 """SELECT p.case_id, p.prediction_type, p.pick, l.y_prob, l.escalated FROM picks p
JOIN lab l ON p.case_id = l.case_id AND p.prediction_type = l.prediction_type""")


@register("representative_rows", ops="G4", doubles=["y_prob"], sql=_REP_SQL)
def q_representative_rows(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    return IN.representative_rows(scored)


@register("silhouette_sample", ops="J4,K11")
def q_silhouette_sample(spark, sf_dir):
    """Preprocessor, PCA and K-Means (k=2) fitted on all rows; silhouette of a seeded sample of them."""
    t = S.kmeans_study(_study_cases(spark, sf_dir), _study_prep(), ks=[2], score_rows=C.SILHOUETTE_SAMPLE)
    return t.select("k", "silhouette_sq_euclidean", F.col("scored_rows").alias("sample_rows"))


@register("report_permutation", ops="P7,M2")
def q_report_permutation(spark, sf_dir):
    """Permutation rows with mean magnitude above 0.001 (all rows if none qualify)."""
    pi = S.fold_permutation_importance(_study_cases(spark, sf_dir), _study_prep(), 0).cache()
    big = pi.filter(F.abs("importance_mean") > 0.001)
    return big if big.limit(1).count() > 0 else pi
