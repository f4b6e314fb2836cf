"""Registered monitoring queries (N1-N9, batch form of the streaming monitors) and SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import clean_text
from ..operators import features as FE
from ..sources.tables import read_table
from ..streaming import monitor as MON
from .queries_ml import _CLEAN_SQL, _TERMS_CTE, _docs_clean
from .registry import REGISTRY, register
from .sql_cases import RECALL, confusion_sql, with_

FMT = "'%Y-%m-%d %H:%M:%S'"
EV = f"""ev AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS escalated,
  least(value, 1e2) / 1e2 AS y_prob, CAST(least(value, 1e2) / 1e2 >= {MON.MONITOR_THRESHOLD} AS INTEGER) AS y_pred,
  CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'afternoon'
       ELSE 'evening' END AS segment FROM events)"""
WEEKS = EV + ",\nwk AS (SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01 00:00:00') AS ws, * FROM ev)"
HIGH = f"CASE WHEN y_prob >= {C.TIER_HIGH} THEN 1.0 ELSE 0.0 END"


def _events(spark, sf_dir):
    return MON.batch_events(spark, sf_dir)


@register("monitor_windows", ops="N1,N2,N3",
          doubles=["flag_rate", "mean_prob", "high_risk_rate", "baseline_mean_prob", "baseline_high_rate"],
          sql=with_(EV + f""",
base AS (SELECT avg(y_prob) AS bm, avg({HIGH}) AS bh FROM ev),
sw AS (SELECT date_trunc('day', ts) - to_days(CAST(j AS INTEGER)) AS ws, y_pred, y_prob FROM ev, range(0, 7) t(j)),
g AS (SELECT ws, count(*) AS n, avg(CAST(y_pred AS DOUBLE)) AS flag_rate, avg(y_prob) AS mean_prob,
  avg({HIGH}) AS high_risk_rate FROM sw GROUP BY ws)""",
                    f"""SELECT strftime(ws, {FMT}) AS window_start, strftime(ws + INTERVAL 7 DAY, {FMT}) AS window_end, n, flag_rate,
  mean_prob, high_risk_rate, bm AS baseline_mean_prob, bh AS baseline_high_rate,
  (flag_rate < {C.FLAG_RATE_BAND[0]} OR flag_rate > {C.FLAG_RATE_BAND[1]}) AS flag_alert,
  abs(mean_prob - bm) > {C.MEAN_PROB_SHIFT} AS mean_shift_alert,
  (high_risk_rate >= {C.HIGH_RATE_FACTOR} * bh OR high_risk_rate <= bh / {C.HIGH_RATE_FACTOR}) AS high_rate_alert
FROM g, base"""))
def q_monitor_windows(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return MON.window_rates(ev, MON.baseline(ev))


_WEEKLY = WEEKS + f""",
wg AS (SELECT ws, count(*) AS n, CAST(sum(escalated) AS BIGINT) AS n_pos, {confusion_sql()} FROM wk GROUP BY ws),
wr AS (SELECT ws, n, n_pos, n_pos / n AS observed_rate, {RECALL} AS recall,
  (n_pos / n < {C.OBSERVED_RATE_BAND[0]} OR n_pos / n > {C.OBSERVED_RATE_BAND[1]}) AS rate_alert,
  ({RECALL}) < {C.RECALL_FLOOR} AS recall_alert FROM wg),
ws2 AS (SELECT strftime(ws, {FMT}) AS week_start, n, n_pos, observed_rate, recall, rate_alert, recall_alert,
  rate_alert AND coalesce(lag(rate_alert) OVER (ORDER BY ws), false) AS rate_alert_2w,
  recall_alert AND coalesce(lag(recall_alert) OVER (ORDER BY ws), false) AS recall_alert_2w FROM wr)"""


@register("monitor_weekly", ops="N4", doubles=["observed_rate", "recall"], sql=with_(_WEEKLY, "SELECT * FROM ws2"))
def q_monitor_weekly(spark, sf_dir):
    return MON.sustained(MON.weekly_outcomes(_events(spark, sf_dir)))


@register("monitor_segments", ops="N5", doubles=["flag_rate", "overall_flag_rate", "relative_deviation"],
          sql=with_(WEEKS + """,
sg AS (SELECT ws, segment, count(*) AS n, sum(y_pred) AS flagged FROM wk GROUP BY ws, segment),
tt AS (SELECT ws, sum(n) AS n_all, sum(flagged) AS flagged_all FROM sg GROUP BY ws),
dv AS (SELECT s.ws, segment, n, flagged / n AS flag_rate, flagged_all / n_all AS overall FROM sg s JOIN tt t ON s.ws = t.ws)""",
                    f"""SELECT strftime(ws, {FMT}) AS week_start, segment, n, flag_rate, overall AS overall_flag_rate,
  CASE WHEN overall > 0 THEN abs(flag_rate - overall) / overall ELSE 0.0 END AS relative_deviation,
  (CASE WHEN overall > 0 THEN abs(flag_rate - overall) / overall ELSE 0.0 END) > {C.SEGMENT_FLAG_DEVIATION} AS alert FROM dv"""))
def q_monitor_segments(spark, sf_dir):
    return MON.segment_deviation(MON.segment_rates(_events(spark, sf_dir)))


def _bin_idx(x: str = "y_prob", edges=C.CALIBRATION_EDGES) -> str:
    parts = []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{x} >= {lo} AND {x} <= {hi}" if i == 0 else f"{x} > {lo} AND {x} <= {hi}"
        parts.append(f"WHEN {cond} THEN {i}")
    return "CASE " + " ".join(parts) + " END"


@register("calibration_drift", ops="N6", doubles=["actual_rate", "baseline_rate", "drift"],
          sql=with_(WEEKS + f""",
cb AS (SELECT ws, {_bin_idx()} AS bin, escalated FROM wk),
pb AS (SELECT ws, bin, count(*) AS n, avg(CAST(escalated AS DOUBLE)) AS actual_rate FROM cb WHERE bin IS NOT NULL GROUP BY ws, bin),
bb AS (SELECT bin, avg(CAST(escalated AS DOUBLE)) AS baseline_rate FROM cb WHERE bin IS NOT NULL GROUP BY bin)""",
                    f"""SELECT strftime(ws, {FMT}) AS week_start, p.bin, n, actual_rate, baseline_rate,
  abs(actual_rate - baseline_rate) AS drift, abs(actual_rate - baseline_rate) > {C.CALIBRATION_DRIFT} AS alert
FROM pb p JOIN bb b ON p.bin = b.bin"""))
def q_calibration_drift(spark, sf_dir):
    return MON.calibration_drift(_events(spark, sf_dir))


_CONV_CLEAN = _CLEAN_SQL.replace("text", "c.text")
_VOCAB_DRIFT = _TERMS_CTE + f""",
ct AS (SELECT c.turn, regexp_extract_all(strip_accents(lower({_CONV_CLEAN})), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM conversations c),
cx AS (SELECT turn, unnest(t) AS term FROM ct),
oov AS (SELECT cx.turn, count(*) AS n_tokens, count(*) FILTER (WHERE v.term IS NULL) AS n_oov
  FROM cx LEFT JOIN vocab v ON cx.term = v.term GROUP BY cx.turn)"""


def _vocab_drift(spark, sf_dir):
    vocab = FE.tfidf_vocabulary(_docs_clean(spark, sf_dir), C.TEXT_COL_CLEAN, FE.TfidfSpec(), "doc_id")
    conv = read_table(spark, sf_dir, "conversations").select("turn", clean_text("text").alias("text_clean"))
    return MON.vocabulary_drift(conv, "turn", vocab, "text_clean")


@register("vocabulary_drift", ops="N7", doubles=["oov_rate"],
          sql=with_(_VOCAB_DRIFT, f"""SELECT turn, n_tokens, n_oov, n_oov / n_tokens AS oov_rate,
  n_oov / n_tokens > {C.OOV_LIMIT} AS alert FROM oov"""))
def q_vocabulary_drift(spark, sf_dir):
    return _vocab_drift(spark, sf_dir)


@register("fairness_audit", ops="N8", doubles=["min_tpr", "max_tpr", "tpr_ratio", "min_fpr", "max_fpr"],
          sql=with_(WEEKS + f""",
fg AS (SELECT ws, segment, {confusion_sql()} FROM wk GROUP BY ws, segment),
fr AS (SELECT ws, segment, {RECALL} AS tpr, CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM fg),
fa AS (SELECT ws, min(tpr) AS min_tpr, max(tpr) AS max_tpr, min(fpr) AS min_fpr, max(fpr) AS max_fpr FROM fr GROUP BY ws)""",
                    f"""SELECT strftime(ws, {FMT}) AS week_start, min_tpr, max_tpr,
  CASE WHEN max_tpr > 0 THEN min_tpr / max_tpr ELSE 0.0 END AS tpr_ratio,
  (CASE WHEN max_tpr > 0 THEN min_tpr / max_tpr ELSE 0.0 END) < {C.FOUR_FIFTHS} AS violates_80_rule, min_fpr, max_fpr FROM fa"""))
def q_fairness_audit(spark, sf_dir):
    return MON.fairness_audit(_events(spark, sf_dir))


@register("retrain_triggers", ops="N9",
          sql=with_(_WEEKLY + ",\n" + _VOCAB_DRIFT + """,
ovr AS (SELECT sum(n_oov) / sum(n_tokens) AS r FROM oov)""",
                    f"""SELECT week_start, abs(observed_rate - {C.TRAINING_BASE_RATE}) > {C.BASE_RATE_CHANGE} AS rate_change,
  recall_alert_2w AS recall_drop_2w, (SELECT r FROM ovr) > {C.OOV_LIMIT} AS vocabulary_drift,
  (row_number() OVER (ORDER BY week_start)) % 13 = 0 AS scheduled_retrain FROM ws2"""))
def q_retrain_triggers(spark, sf_dir):
    weekly = MON.weekly_outcomes(_events(spark, sf_dir))
    vd = _vocab_drift(spark, sf_dir)
    r = vd.agg((F.sum("n_oov") / F.sum("n_tokens")).alias("r")).first()["r"]  # one scalar
    return MON.retrain_triggers(weekly, float(r or 0.0))


@register("monitor_windows_stream", ops="N1,N2,N3",
          doubles=["flag_rate", "mean_prob", "high_risk_rate", "baseline_mean_prob", "baseline_high_rate"],
          sql=None)
def q_monitor_windows_stream(spark, sf_dir):
    """N1-N3 run as a Structured Streaming query over the events files (file source, watermark,
    sliding windows, memory sink drained to completion); same result as the batch form."""
    import os
    import uuid
    from ..session import ensure_checkpoint_dir
    base = MON.baseline(_events(spark, sf_dir))
    name = "tk_windows_" + uuid.uuid4().hex[:12]
    ck = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    # event time is read as UTC while the stream runs (watermarks need instants); restored afterwards
    tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        stream = MON.event_stream(spark, os.path.join(sf_dir, "events*.parquet"))
        q = MON.start_window_monitor(spark, stream, base, name, ck, output_mode="complete")
        q.processAllAvailable()
        q.stop()
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    return spark.table(name)


# the streamed windows have the batch form's SQL twin
REGISTRY["monitor_windows_stream"].sql = REGISTRY["monitor_windows"].sql
