"""Metric expressions over confusion counts and scores.

Every ratio with a zero denominator is 0, not NULL (the convention of the
analyses these re-create).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(n, d) -> Column:
    n, d = _c(n), _c(d)
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def confusion_aggs(label="escalated", pred="y_pred") -> list[Column]:
    """tp, fp, fn, tn as four conditional counts."""
    y, p = _c(label), _c(pred)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def f_beta(tp="tp", fp="fp", fn="fn", beta: float = 2.0) -> Column:
    """F-beta from counts: (1+b^2) tp / (b^2 (tp+fn) + (tp+fp)), 0 if undefined."""
    tp, fp, fn = _c(tp), _c(fp), _c(fn)
    b2 = beta * beta
    num = F.lit(1.0 + b2) * tp
    den = F.lit(b2) * (tp + fn) + (tp + fp)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def f2(tp="tp", fp="fp", fn="fn") -> Column:
    return f_beta(tp, fp, fn, 2.0)


def precision(tp="tp", fp="fp") -> Column:
    return safe_div(_c(tp), _c(tp) + _c(fp))


def recall(tp="tp", fn="fn") -> Column:
    return safe_div(_c(tp), _c(tp) + _c(fn))


def fpr(fp="fp", tn="tn") -> Column:
    return safe_div(_c(fp), _c(fp) + _c(tn))


def f2_from_pr(p, r) -> Column:
    """F2 from a precision/recall pair (curve points): 5PR/(4P+R), 0 if P+R=0."""
    p, r = _c(p), _c(r)
    return F.when(p + r > 0, F.lit(5) * p * r / (F.lit(4) * p + r)).otherwise(F.lit(0.0))


def cost(tp="tp", fp="fp", fn="fn", tn=None, fn_cost=C.COST_FN, fp_cost=C.COST_FP,
         tp_cost=C.COST_TP, tn_cost=C.COST_TN) -> Column:
    """Total cost of a confusion matrix (integer GBP)."""
    e = _c(tp) * tp_cost + _c(fp) * fp_cost + _c(fn) * (fn_cost if isinstance(fn_cost, (int, float)) else _c(fn_cost))
    if tn is not None and tn_cost:
        e = e + _c(tn) * tn_cost
    return e


def prediction_type(label="escalated", pred="y_pred") -> Column:
    """TP / FP / FN / TN label per row."""
    y, p = _c(label), _c(pred)
    return (F.when((y == 1) & (p == 1), "TP").when((y == 0) & (p == 1), "FP")
            .when((y == 1) & (p == 0), "FN").otherwise("TN"))


def apply_threshold(score, t) -> Column:
    """(score >= t) as 0/1 int."""
    t = t if isinstance(t, Column) else F.lit(float(t))
    return (_c(score) >= t).cast("int")


def risk_tier(score, mean_thresh, high: float = C.TIER_HIGH) -> Column:
    """HIGH / MEDIUM / LOW tier."""
    s = _c(score)
    mt = mean_thresh if isinstance(mean_thresh, Column) else F.lit(float(mean_thresh))
    return F.when(s >= F.lit(high), "HIGH").when(s >= mt, "MEDIUM").otherwise("LOW")


def right_closed_bin(x, edges=C.CALIBRATION_EDGES) -> Column:
    """Label of the right-closed interval containing x, lowest edge included.

    Labels follow interval notation, first bin ``[e0, e1]`` then ``(e_i, e_i+1]``.
    Values outside the edges get NULL.
    """
    x = _c(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        label = f"[{lo}, {hi}]" if i == 0 else f"({lo}, {hi}]"
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def right_closed_bin_index(x, edges=C.CALIBRATION_EDGES) -> Column:
    """0-based index of the right-closed bin (B17), NULL outside the edges."""
    x = _c(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def mean_std_text(m, s, digits: int = 4) -> Column:
    """'mean (+/-std)' with fixed decimals."""
    return F.format_string(f"%.{digits}f (+/-%.{digits}f)", _c(m), _c(s))
