"""Registered profiling and association-test queries (EDA / multicollinearity) and SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..operators import evaluation as E
from ..operators import profiling as PF
from ..operators import stats as ST
from ..sources.cases import cases, prepare
from ..sources.tables import read_table
from .registry import register
from .scoring import scored_with_thresholds
from .sql_cases import CASES, F2, MODEL, SCORED, confusion_sql, unpivot_sql, with_

CASE_COLS = ["case_id", "customer_id", "ts", "escalation_level", "escalated", "customer_type", "tenure_type",
             "meter_type", "region", "issue_category", "sentiment", "emotion_intensity", "resolution_time",
             "y_prob", "fold"]
PREPARED_COLS = ["case_id", "customer_id", "escalation_level", "escalated", "customer_type", "tenure_type",
                 "meter_type", "region", "issue_category", "sentiment", "emotion_intensity", "resolution_time",
                 "hour", "day_of_week", "month"]
LINE_NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
WORD_RUN = r"[^\s\p{Z}\x{1c}-\x{1f}\x{85}]+"
DOCS = "documents"


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def _text_labelled(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("escalated"))
    return d.join(lab, "doc_id")


@register("prepare_cases", ops="A2,B1-B5,B7", raw=["emotion_intensity", "resolution_time"],
          sql=with_(MODEL, f"SELECT {', '.join(PREPARED_COLS)} FROM model_cases"))
def q_prepare_cases(spark, sf_dir):
    return prepare(cases(spark, sf_dir)).select(*PREPARED_COLS)


# The columns and types of the case view.
_CASE_COLUMNS = [("case_id", "bigint"), ("customer_id", "bigint"), ("ts", "timestamp_ntz"), ("escalation_level", "int"),
                 ("escalated", "int"), ("customer_type", "string"), ("tenure_type", "string"), ("meter_type", "string"),
                 ("region", "string"), ("issue_category", "string"), ("sentiment", "string"),
                 ("emotion_intensity", "double"), ("resolution_time", "double"), ("y_prob", "double"), ("fold", "int")]


@register("table_profile", ops="A3",
          sql=with_(CASES, 'SELECT c AS "column", t AS dtype, (SELECT count(*) FROM cases) AS n_rows FROM (VALUES '
                    + ", ".join(f"('{c}', '{t}')" for c, t in _CASE_COLUMNS) + ") AS v(c, t)"))
def q_table_profile(spark, sf_dir):
    return PF.table_profile(cases(spark, sf_dir))


@register("clean_text", ops="B6,B8,B9,O1",
          sql=f"""SELECT doc_id,
  trim(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text_clean,
  CAST(length(text) AS INTEGER) AS n_chars,
  CAST(len(regexp_extract_all(text, '{WORD_RUN}')) AS INTEGER) AS word_count
FROM {DOCS}""")
def q_clean_text(spark, sf_dir):
    return PF.text_stats(_docs(spark, sf_dir), "doc_id", "text")


@register("category_rates", ops="D1,D2", doubles=["escalation_rate"],
          sql=with_(CASES + ",\nlg AS (" + unpivot_sql("cases", C.PROFILE_CAT_COLS, ["escalated"], "\"column\"", "value") + ")",
                    'SELECT "column", value, count(*) AS n, avg(CAST(escalated AS DOUBLE)) AS escalation_rate FROM lg GROUP BY ALL'))
def q_category_rates(spark, sf_dir):
    return PF.category_rates(cases(spark, sf_dir), C.PROFILE_CAT_COLS)


@register("segment_imbalance", ops="D3", doubles=["rate"],
          sql=with_(CASES + ",\nlg AS (" + unpivot_sql("cases", C.TEST_CAT_COLS, ["escalated"], "\"column\"", "value") + ")",
                    """SELECT "column", value, avg(CAST(escalated AS DOUBLE)) AS rate, CAST(sum(escalated) AS BIGINT) AS n_pos,
  count(*) AS n_total FROM lg WHERE value IS NOT NULL GROUP BY ALL"""))
def q_segment_imbalance(spark, sf_dir):
    return PF.segment_imbalance(cases(spark, sf_dir), C.TEST_CAT_COLS)


_DESC_DOUBLES = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def _describe_sql(source: str, cols: list[str], keys: list[str]) -> str:
    ks = "".join(f"{k}, " for k in keys)
    parts = " UNION ALL ".join(f"SELECT {ks}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {source}" for c in cols)
    return f"""dl AS ({parts})
SELECT {ks}"column", count(v) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min,
  quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max
FROM dl WHERE v IS NOT NULL GROUP BY {ks}"column\""""


@register("numeric_describe", ops="D4", doubles=_DESC_DOUBLES,
          sql=with_(CASES + ",\n" + _describe_sql("cases", ["emotion_intensity", "resolution_time"], []).split("\nSELECT", 1)[0],
                    "SELECT" + _describe_sql("cases", ["emotion_intensity", "resolution_time"], []).split("\nSELECT", 1)[1]))
def q_numeric_describe(spark, sf_dir):
    return PF.numeric_describe(cases(spark, sf_dir), ["emotion_intensity", "resolution_time"])


_GD = _describe_sql("tl", ["n_chars", "word_count"], ["escalated"])


@register("grouped_describe", ops="D5", doubles=_DESC_DOUBLES,
          sql=with_(f"""tl AS (SELECT l.toxic AS escalated, length(d.text) AS n_chars,
  len(regexp_extract_all(d.text, '{WORD_RUN}')) AS word_count
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
""" + _GD.split("\nSELECT", 1)[0], "SELECT" + _GD.split("\nSELECT", 1)[1]))
def q_grouped_describe(spark, sf_dir):
    t = _text_labelled(spark, sf_dir)
    st = PF.text_stats(t.withColumnRenamed("doc_id", "id"), "id", "text").join(
        t.select(F.col("doc_id").alias("id"), "escalated"), "id")
    return PF.numeric_describe(st, ["n_chars", "word_count"], ["escalated"])


@register("duplicate_texts", ops="D7,G2",
          sql=f"""SELECT text, count(*) AS n FROM {DOCS} WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1
ORDER BY n DESC, text LIMIT 5""")
def q_duplicate_texts(spark, sf_dir):
    return PF.duplicate_texts(_docs(spark, sf_dir), "text", 5)


@register("text_uniqueness", ops="D6,D7",
          sql=f"""WITH g AS (SELECT text, count(*) AS n FROM {DOCS} WHERE text IS NOT NULL GROUP BY text)
SELECT CAST(sum(n) AS BIGINT) AS n_total, count(*) AS n_unique, CAST(sum(n) - count(*) AS BIGINT) AS n_excess,
  CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_in_duplicate_groups,
  count(*) FILTER (WHERE n > 1) AS n_duplicated_texts FROM g""")
def q_text_uniqueness(spark, sf_dir):
    return PF.text_uniqueness(_docs(spark, sf_dir), "text")


_WORDS = f"""w AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD_RUN}')) AS word FROM {DOCS}),
wc AS (SELECT word, count(*) AS n FROM w GROUP BY word)"""


@register("top_words", ops="B20,D8,G2", sql=with_(_WORDS, "SELECT word, n FROM wc ORDER BY n DESC, word LIMIT 20"))
def q_top_words(spark, sf_dir):
    return PF.top_words(_docs(spark, sf_dir), "text", 20)


@register("vocabulary_size", ops="D8",
          sql=with_(_WORDS, "SELECT count(*) AS vocabulary_size, CAST(sum(n) AS BIGINT) AS n_words FROM wc"))
def q_vocabulary_size(spark, sf_dir):
    return PF.vocabulary_size(_docs(spark, sf_dir), "text")


@register("rate_by_calendar", ops="D9,D10", doubles=["escalation_rate"],
          sql=with_(CASES + """,
cl AS (SELECT CAST(escalated AS DOUBLE) AS y, CAST(year(ts) AS VARCHAR) AS year, dayname(ts) AS day_name,
  CAST(hour(ts) AS VARCHAR) AS hour FROM cases),
lg AS (SELECT 'year' AS dimension, year AS key, y FROM cl UNION ALL SELECT 'day_name', day_name, y FROM cl
       UNION ALL SELECT 'hour', hour, y FROM cl)""",
                    "SELECT dimension, key, avg(y) AS escalation_rate, count(*) AS n FROM lg GROUP BY ALL"))
def q_rate_by_calendar(spark, sf_dir):
    return PF.rate_by_calendar(cases(spark, sf_dir))


@register("date_range", ops="D9",
          sql=with_(CASES, """SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_ts,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_ts, count(*) AS n FROM cases"""))
def q_date_range(spark, sf_dir):
    return PF.date_range(cases(spark, sf_dir))


@register("missing_profile", ops="B10,D11", doubles=["missing_pct"],
          sql=with_(CASES + ",\nmc AS (" + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n FROM cases"
              for c in CASE_COLS) + ")",
              'SELECT "column", missing_count, missing_count / n * 100 AS missing_pct FROM mc WHERE missing_count > 0'))
def q_missing_profile(spark, sf_dir):
    return PF.missing_profile(cases(spark, sf_dir).select(*CASE_COLS))


_CONV_STR = ["role", "text"]


@register("hidden_missing", ops="B11",
          sql=" UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g') = '') AS n_blank "
              f"FROM conversations HAVING count(*) FILTER (WHERE regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g') = '') > 0"
              for c in _CONV_STR))
def q_hidden_missing(spark, sf_dir):
    return PF.hidden_missing(read_table(spark, sf_dir, "conversations").select(*_CONV_STR))


@register("contingency", ops="D12",
          sql=with_(CASES + """,
ct AS (SELECT CAST(escalated AS VARCHAR) AS a, CAST(CASE WHEN sentiment IS NULL THEN 1 ELSE 0 END AS VARCHAR) AS b FROM cases)""",
                    """SELECT coalesce(a, 'total') AS row_key, coalesce(b, 'total') AS col_key, count(*) AS n
FROM ct GROUP BY CUBE (a, b)"""))
def q_contingency(spark, sf_dir):
    c = cases(spark, sf_dir).withColumn("sentiment_missing", F.col("sentiment").isNull().cast("int"))
    return PF.contingency(c, "escalated", "sentiment_missing")


@register("missing_by_level", ops="D13", doubles=["missing_rate_pct"],
          sql=with_(CASES + """,
ml AS (SELECT CASE WHEN sentiment IS NULL THEN 1.0 ELSE 0.0 END AS m, CAST(escalated AS VARCHAR) AS escalated,
  CAST(escalation_level AS VARCHAR) AS escalation_level FROM cases),
lg AS (SELECT 'escalated' AS dimension, escalated AS key, m FROM ml UNION ALL
       SELECT 'escalation_level', escalation_level, m FROM ml)""",
                    "SELECT dimension, key, avg(m) * 100 AS missing_rate_pct, count(*) AS n FROM lg GROUP BY ALL"))
def q_missing_by_level(spark, sf_dir):
    return PF.missing_by_level(cases(spark, sf_dir))


@register("class_stats", ops="D35", doubles=["mean", "std"],
          sql=with_(CASES + """,
lg AS (SELECT escalated, 'emotion_intensity' AS "column", emotion_intensity AS v FROM cases UNION ALL
       SELECT escalated, 'resolution_time', resolution_time FROM cases)""",
                    'SELECT escalated, "column", avg(v) AS mean, stddev_samp(v) AS std, count(v) AS n FROM lg GROUP BY ALL'))
def q_class_stats(spark, sf_dir):
    return PF.class_stats(cases(spark, sf_dir), ["emotion_intensity", "resolution_time"])


@register("target_distribution", ops="D36", doubles=["pct"],
          sql=with_(CASES, """SELECT escalated, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct
FROM cases GROUP BY escalated"""))
def q_target_distribution(spark, sf_dir):
    return PF.target_distribution(cases(spark, sf_dir))


@register("entity_repeats", ops="D14",
          sql=with_(CASES + ",\nper AS (SELECT customer_id, count(*) AS k FROM cases GROUP BY customer_id)",
                    f"""SELECT CASE WHEN k >= {C.REPEAT_CAP} THEN '>{C.REPEAT_CAP - 1}' ELSE CAST(k AS VARCHAR) END AS rows_per_entity,
  count(*) AS n_entities FROM per GROUP BY 1"""))
def q_entity_repeats(spark, sf_dir):
    return PF.entity_repeats(cases(spark, sf_dir))


@register("mixed_outcomes", ops="C1,C2,D15",
          sql=with_(CASES + """,
per AS (SELECT customer_id, count(*) AS k, min(escalated) AS lo, max(escalated) AS hi FROM cases GROUP BY customer_id)""",
                    """SELECT count(*) AS n_multi, count(*) FILTER (WHERE lo <> hi) AS n_mixed,
  count(*) FILTER (WHERE lo = hi AND hi = 0) AS n_all_negative, count(*) FILTER (WHERE lo = hi AND hi = 1) AS n_all_positive
FROM per WHERE k > 1"""))
def q_mixed_outcomes(spark, sf_dir):
    return PF.mixed_outcomes(cases(spark, sf_dir))


@register("histogram", ops="D34", doubles=["bin_lo"],
          sql=with_(CASES + """,
mm AS (SELECT min(emotion_intensity) AS lo, max(emotion_intensity) AS hi FROM cases),
hb AS (SELECT escalated, CAST(least(floor((emotion_intensity - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END) * 30) + 1, 30) AS INTEGER) AS bin,
  lo, CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END AS width FROM cases, mm WHERE emotion_intensity IS NOT NULL)""",
                    "SELECT escalated, bin, lo + (bin - 1) * (width / 30) AS bin_lo, count(*) AS n FROM hb GROUP BY escalated, bin, lo, width"))
def q_histogram(spark, sf_dir):
    return PF.histogram(cases(spark, sf_dir), "emotion_intensity", 30, ["escalated"])


# ------------------------------------------------------------------------------------------- tests

def _chi_sql(long_sql: str) -> str:
    return f"""lg AS ({long_sql}),
cells AS (SELECT test, a, b, count(*) AS o FROM lg WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL),
ra AS (SELECT test, a, sum(o) AS ra FROM cells GROUP BY ALL),
cb AS (SELECT test, b, sum(o) AS cb FROM cells GROUP BY ALL),
dims AS (SELECT test, CAST(sum(o) AS BIGINT) AS n, count(DISTINCT a) AS n_rows, count(DISTINCT b) AS n_cols FROM cells GROUP BY test),
grid AS (SELECT r.test, r.a, c.b, r.ra, c.cb, coalesce(x.o, 0) AS o FROM ra r JOIN cb c ON r.test = c.test
  LEFT JOIN cells x ON x.test = r.test AND x.a = r.a AND x.b = c.b),
terms AS (SELECT g.test, d.n, d.n_rows, d.n_cols, g.ra * g.cb / d.n AS e, abs(g.o - g.ra * g.cb / d.n) AS diff
  FROM grid g JOIN dims d ON g.test = d.test),
adj AS (SELECT *, CASE WHEN n_rows = 2 AND n_cols = 2 THEN greatest(diff - 0.5, 0.0) ELSE diff END AS ad FROM terms),
chi AS (SELECT test, n, n_rows, n_cols, (n_rows - 1) * (n_cols - 1) AS dof, sum(ad * ad / e) AS chi2
  FROM adj GROUP BY test, n, n_rows, n_cols)"""


_LEAK_LONG = ("SELECT 'sentiment_missing' AS test, CAST(escalated AS VARCHAR) AS a, "
              "CAST(CASE WHEN sentiment IS NULL THEN 1 ELSE 0 END AS VARCHAR) AS b FROM cases UNION ALL "
              "SELECT 'sentiment', sentiment, CAST(escalated AS VARCHAR) FROM cases UNION ALL "
              + " UNION ALL ".join(f"SELECT '{c}', CAST({c} AS VARCHAR), CAST(escalated AS VARCHAR) FROM cases"
                                   for c in C.TEST_CAT_COLS))


@register("chi_square", ops="E1", doubles=["chi2"],
          sql=with_(CASES + ",\n" + _chi_sql(_LEAK_LONG), "SELECT * FROM chi"))
def q_chi_square(spark, sf_dir):
    return ST.leakage_tests(cases(spark, sf_dir))


@register("chi_square_p", ops="E1")
def q_chi_square_p(spark, sf_dir):
    return ST.with_p_values(ST.leakage_tests(cases(spark, sf_dir)))


_CV_COLS = C.CATEGORICAL_COLS
_CV_LONG = " UNION ALL ".join(
    f"SELECT '{_CV_COLS[i]}|{_CV_COLS[j]}' AS test, CAST({_CV_COLS[i]} AS VARCHAR) AS a, CAST({_CV_COLS[j]} AS VARCHAR) AS b "
    f"FROM model_cases" for i in range(len(_CV_COLS)) for j in range(i + 1, len(_CV_COLS)))
_CV_BODY = """SELECT split_part(test, '|', 1) AS feature_1, split_part(test, '|', 2) AS feature_2,
  CASE WHEN least(n_rows, n_cols) - 1 = 0 OR n = 0 THEN 0.0 ELSE sqrt(chi2 / (n * (least(n_rows, n_cols) - 1))) END AS cramers_v
FROM chi"""


@register("cramers_v", ops="E6,O3", doubles=["cramers_v"], sql=with_(MODEL + ",\n" + _chi_sql(_CV_LONG), _CV_BODY))
def q_cramers_v(spark, sf_dir):
    return ST.cramers_v(prepare(cases(spark, sf_dir)))


@register("cramers_matrix", ops="P3,E6", doubles=["cramers_v"],
          sql=with_(MODEL + ",\n" + _chi_sql(_CV_LONG) + ",\ncv AS (" + _CV_BODY + ")",
                    "SELECT * FROM cv UNION ALL SELECT feature_2, feature_1, cramers_v FROM cv UNION ALL "
                    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in _CV_COLS)))
def q_cramers_matrix(spark, sf_dir):
    return ST.cramers_matrix(ST.cramers_v(prepare(cases(spark, sf_dir))))


@register("mann_whitney", ops="E2", doubles=["u", "z", "tie_term"],
          sql=with_(CASES + """,
h AS (SELECT emotion_intensity AS v, count(*) AS c, count(*) FILTER (WHERE escalated = 0) AS c0 FROM cases
      WHERE emotion_intensity IS NOT NULL GROUP BY 1),
r AS (SELECT *, sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_c FROM h),
s AS (SELECT sum(c0 * ((cum_c - c) + (c + 1) / 2.0)) AS r0, CAST(sum(c0) AS BIGINT) AS n0, CAST(sum(c) AS BIGINT) AS n,
      CAST(sum(c * c * c - c) AS BIGINT) AS tie FROM r),
u AS (SELECT n0, n - n0 AS n1, n, tie, r0 - n0 * (n0 + 1) / 2.0 AS u FROM s)""",
                    """SELECT n0, n1, u, (greatest(u, n0 * n1 - u) - n0 * n1 / 2.0 - 0.5) /
  sqrt(n0 * n1 / 12.0 * ((n + 1) - tie / (n * (n - 1)))) AS z, tie AS tie_term FROM u"""))
def q_mann_whitney(spark, sf_dir):
    return ST.mann_whitney(cases(spark, sf_dir), "emotion_intensity")


@register("mann_whitney_p", ops="E2")
def q_mann_whitney_p(spark, sf_dir):
    return ST.mann_whitney_p(ST.mann_whitney(cases(spark, sf_dir), "emotion_intensity"))


def _fold_f2(scored, pred_col):
    c = scored.groupBy("fold").agg(*M.confusion_aggs(pred=pred_col))
    return c.select("fold", M.f2().alias("f2"))


@register("paired_t", ops="E3", doubles=["mean_diff", "sd", "t"],
          sql=with_(SCORED + f""",
a AS (SELECT fold, {confusion_sql()} FROM scored GROUP BY fold),
b AS (SELECT fold, {confusion_sql(pred='CAST(y_prob >= 0.5 AS INTEGER)')} FROM scored GROUP BY fold),
fa AS (SELECT fold, {F2} AS f2 FROM a), fb AS (SELECT fold, {F2} AS f2 FROM b),
d AS (SELECT fa.f2 - fb.f2 AS d FROM fa JOIN fb ON fa.fold = fb.fold)""",
                    "SELECT count(*) AS n, avg(d) AS mean_diff, stddev_samp(d) AS sd, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t FROM d"))
def q_paired_t(spark, sf_dir):
    scored, _, _ = scored_with_thresholds(spark, sf_dir)
    base = scored.withColumn("y_default", M.apply_threshold("y_prob", 0.5))
    return ST.paired_t(_fold_f2(scored, "y_pred"), _fold_f2(base, "y_default"))


@register("paired_t_p", ops="E3")
def q_paired_t_p(spark, sf_dir):
    return ST.paired_t_p(q_paired_t(spark, sf_dir))


_CORR_SQL = "cr AS (" + " UNION ALL ".join(
    f"SELECT '{LINE_NUMERICS[i]}' AS col_a, '{LINE_NUMERICS[j]}' AS col_b, corr({LINE_NUMERICS[i]}, {LINE_NUMERICS[j]}) AS r FROM lineitem"
    for i in range(len(LINE_NUMERICS)) for j in range(i + 1, len(LINE_NUMERICS))) + ")"


@register("correlations", ops="E4", doubles=["r"], sql=with_(_CORR_SQL, "SELECT * FROM cr"))
def q_correlations(spark, sf_dir):
    return ST.correlations(read_table(spark, sf_dir, "lineitem"), LINE_NUMERICS)


@register("max_correlation", ops="E5", doubles=["max_abs_r"],
          sql=with_(_CORR_SQL, f"""SELECT first(col_a ORDER BY abs(r) DESC) AS col_a, first(col_b ORDER BY abs(r) DESC) AS col_b,
  max(abs(r)) AS max_abs_r,
  CASE WHEN max(abs(r)) < {C.CORR_LOW} THEN 'none' WHEN max(abs(r)) < {C.CORR_HIGH} THEN 'moderate' ELSE 'high' END AS verdict
FROM cr"""))
def q_max_correlation(spark, sf_dir):
    return ST.max_correlation(ST.correlations(read_table(spark, sf_dir, "lineitem"), LINE_NUMERICS))


def _vif_ctes(cols: list[str]) -> str:
    """Closed-form VIF for four columns: diagonal of the inverse correlation matrix = minor / determinant."""
    r = {(i, j): f"corr({x}, {y})" for i, x in enumerate(cols) for j, y in enumerate(cols) if i < j}
    det = ("1 - (r12*r12 + r13*r13 + r14*r14 + r23*r23 + r24*r24 + r34*r34)"
           " + (r12*r12*r34*r34 + r13*r13*r24*r24 + r14*r14*r23*r23)"
           " + 2*(r12*r13*r23 + r12*r14*r24 + r13*r14*r34 + r23*r24*r34)"
           " - 2*(r12*r13*r24*r34 + r12*r14*r23*r34 + r13*r14*r23*r24)")
    minor = lambda x, y, z: f"(1 + 2*{x}*{y}*{z} - {x}*{x} - {y}*{y} - {z}*{z})"
    minors = [minor("r23", "r24", "r34"), minor("r13", "r14", "r34"), minor("r12", "r14", "r24"), minor("r12", "r13", "r23")]
    rs = ", ".join(f"{r[k]} AS r{k[0] + 1}{k[1] + 1}" for k in sorted(r))
    parts = " UNION ALL ".join(f"SELECT '{col}' AS feature, {m} / ({det}) AS vif FROM rr" for col, m in zip(cols, minors))
    return f"rr AS (SELECT {rs} FROM lineitem),\nvf AS ({parts})"


def _vif_sql(cols: list[str]) -> str:
    return with_(_vif_ctes(cols), f"""SELECT feature, vif, 1 - 1 / vif AS r_squared,
  CASE WHEN vif < {C.VIF_WARN} THEN 'ok' WHEN vif < {C.VIF_HIGH} THEN 'moderate' ELSE 'high' END AS verdict FROM vf""")


@register("vif", ops="E7", doubles=["vif", "r_squared"], sql=_vif_sql(LINE_NUMERICS))
def q_vif(spark, sf_dir):
    return ST.vif(read_table(spark, sf_dir, "lineitem"), LINE_NUMERICS)


@register("short_texts", ops="B12,B8,B9",
          sql=f"""SELECT count(*) AS n_texts, count(*) FILTER (WHERE length(text) < 10) AS n_under_10_chars,
  count(*) FILTER (WHERE len(regexp_extract_all(text, '{WORD_RUN}')) < 3) AS n_under_3_words
FROM {DOCS} WHERE text IS NOT NULL""")
def q_short_texts(spark, sf_dir):
    st = PF.text_stats(_docs(spark, sf_dir).filter(F.col("text").isNotNull()), "doc_id", "text")
    return st.agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(F.col("n_chars") < 10).alias("n_under_10_chars"),
                  F.count_if(F.col("word_count") < 3).alias("n_under_3_words"))
