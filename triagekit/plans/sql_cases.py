"""DuckDB-side SQL for the case views, used to build the oracle queries.

The same logical definitions as ``sources.cases`` / ``plans.scoring``, written
as plain SQL CTEs over the pre-registered test tables.
"""

CASES = """
cases AS (
SELECT o.o_orderkey AS case_id, o.o_custkey AS customer_id, o.o_orderdate AS ts,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2
       WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS escalation_level,
  CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END AS escalated,
  c.c_mktsegment AS customer_type,
  CASE WHEN c.c_acctbal >= 4500 THEN 'Long-term' ELSE 'New' END AS tenure_type,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'Smart' ELSE 'Standard' END AS meter_type,
  r.r_name AS region, n.n_name AS issue_category,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 'Negative'
       WHEN o.o_orderstatus = 'O' THEN 'Neutral' ELSE 'Positive' END AS sentiment,
  o.o_totalprice / 5e5 AS emotion_intensity,
  CAST((o.o_orderkey * 31) % 720 AS DOUBLE) / 1e1 AS resolution_time,
  CAST((o.o_orderkey * 7919) % 59999 + CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') AND o.o_orderkey % 5 <> 3
       THEN 40000 ELSE 0 END AS DOUBLE) / 1e5 AS y_prob,
  CAST(o.o_custkey % 5 AS INT) AS fold
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

MODEL = CASES + """,
model_cases AS (
SELECT * REPLACE (coalesce(sentiment, 'Unknown') AS sentiment),
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month
FROM cases
)"""

# Per-fold F2-best threshold tuned on the other folds' rows, then decisions.
SCORED = MODEL + """,
th_hist AS (SELECT fold, y_prob AS s, count(*) AS n, sum(escalated) AS pos FROM model_cases GROUP BY fold, y_prob),
th_folds AS (SELECT DISTINCT fold AS k FROM model_cases),
th_train AS (SELECT f.k, h.s, sum(h.n) AS n, sum(h.pos) AS pos FROM th_folds f JOIN th_hist h ON h.fold <> f.k
             GROUP BY f.k, h.s),
th_cum AS (SELECT k, s,
  CAST(sum(pos) OVER (PARTITION BY k ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS tp,
  CAST(sum(n) OVER (PARTITION BY k ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS nn,
  CAST(sum(pos) OVER (PARTITION BY k) AS DOUBLE) AS p_tot FROM th_train),
th_pr AS (SELECT k, s, tp / nn AS prec, CASE WHEN p_tot = 0 THEN 1.0 ELSE tp / p_tot END AS rec FROM th_cum),
th_f2 AS (SELECT k, s, CASE WHEN prec + rec > 0 THEN 5 * prec * rec / (4 * prec + rec) ELSE 0.0 END AS f2 FROM th_pr),
thr AS (SELECT k AS fold, s AS threshold FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY f2 DESC, s ASC) AS rn FROM th_f2) WHERE rn = 1),
scored AS (SELECT m.*, t.threshold, CAST(m.y_prob >= t.threshold AS INTEGER) AS y_pred
           FROM model_cases m JOIN thr t ON m.fold = t.fold)"""

# Decisions at the mean of the per-fold thresholds.
SCORED_MEAN = SCORED + """,
mean_thr AS (SELECT avg(threshold) AS mt FROM thr),
scored_mean AS (SELECT m.*, mt AS threshold, CAST(m.y_prob >= mt AS INTEGER) AS y_pred
                FROM model_cases m CROSS JOIN mean_thr)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


def confusion_sql(label: str = "escalated", pred: str = "y_pred") -> str:
    return (f"CAST(sum(CASE WHEN {label} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(sum(CASE WHEN {label} = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(sum(CASE WHEN {label} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            f"CAST(sum(CASE WHEN {label} = 0 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn")


F2 = "CASE WHEN 4.0 * (tp + fn) + (tp + fp) > 0 THEN 5.0 * tp / (4.0 * (tp + fn) + (tp + fp)) ELSE 0.0 END"
PRECISION = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END"
RECALL = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END"
FPR = "CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END"


def unpivot_sql(source: str, cols: list[str], extra: list[str], seg: str = "segment", cat: str = "category") -> str:
    ex = ", ".join(extra)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {seg}, CAST({c} AS VARCHAR) AS {cat}, {ex} FROM {source}" for c in cols)


def pr_auc_sql(source: str, keys: list[str], score: str = "y_prob", label: str = "escalated",
               name: str = "auc") -> str:
    """CTEs computing the trapezoid PR-AUC per key over ``source`` (named ``{name}``)."""
    k = ", ".join(keys)
    part = f"PARTITION BY {k}" if keys else ""
    kc = (k + ", ") if keys else ""
    return f"""{name}_h AS (SELECT {kc}{score} AS s, count(*) AS n, sum({label}) AS pos FROM {source} GROUP BY {kc}{score}),
{name}_c AS (SELECT {kc}s, n, pos,
  CAST(sum(pos) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS tp,
  CAST(sum(n) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS nn,
  CAST(sum(pos) OVER ({part}) AS DOUBLE) AS p_tot FROM {name}_h),
{name}_p AS (SELECT {kc}
  CASE WHEN p_tot = 0 THEN 1.0 ELSE tp / p_tot END AS rec, tp / nn AS prec,
  CASE WHEN nn - n > 0 THEN (CASE WHEN p_tot = 0 THEN 1.0 ELSE (tp - pos) / p_tot END) ELSE 0.0 END AS rec0,
  CASE WHEN nn - n > 0 THEN (tp - pos) / (nn - n) ELSE 1.0 END AS prec0 FROM {name}_c),
{name} AS (SELECT {kc}sum((rec - rec0) * (prec + prec0) / 2) AS pr_auc FROM {name}_p {"GROUP BY " + k if keys else ""})"""
