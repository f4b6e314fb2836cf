"""Registered monitors that run as streams over the given tables (late labels, baseline, segments, months) and SQL twins.

Append mode emits what the watermark has closed: windows and months that end at
least a day before the last event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..sources import cases as CS
from ..sources.tables import read_table
from ..streaming import monitor as MON
from ..streaming import outcomes as OUT
from .queries_monitor import EV, FMT, WEEKS, _bin_idx
from .registry import register
from .sql_cases import CASES, FPR, RECALL, confusion_sql, with_

ATTRIBUTES = ["region", "customer_type"]


def _stream(spark, sf_dir, table="events"):
    return (spark.readStream.schema(read_table(spark, sf_dir, table).schema).parquet(f"{sf_dir}/{table}*.parquet"))


@register("monitor_late_labels", ops="N4", doubles=["observed_rate", "recall"],
          sql=with_(EV + f""",
lab AS (SELECT event_id, ts + to_hours(event_id * 37 % 480) AS label_ts FROM events),
m AS (SELECT ev.*, label_ts, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01 00:00:00') AS ws FROM ev JOIN lab USING (event_id)
  WHERE label_ts >= ts AND label_ts <= ts + INTERVAL {OUT.LABEL_DAYS} DAY),
g AS (SELECT ws, count(*) AS n_labelled, CAST(sum(escalated) AS BIGINT) AS n_pos,
  CAST(max(datediff('day', ts, label_ts)) AS INTEGER) AS latest_days, {confusion_sql()} FROM m GROUP BY ws)""",
                    f"""SELECT strftime(ws, {FMT}) AS week_start, n_labelled, n_pos, n_pos / n_labelled AS observed_rate,
  {RECALL} AS recall, latest_days,
  (n_pos / n_labelled < {C.OBSERVED_RATE_BAND[0]} OR n_pos / n_labelled > {C.OBSERVED_RATE_BAND[1]}) AS rate_alert,
  ({RECALL}) < {C.RECALL_FLOOR} AS recall_alert FROM g"""))
def q_late_labels(spark, sf_dir):
    """Two streams, scores and labels, joined within the label bound; weeks are read from the sink."""
    scored, labels = MON.score_events(_stream(spark, sf_dir)), OUT.label_stream(_stream(spark, sf_dir))
    return OUT.labelled_weeks(OUT.run_to_files(OUT.with_labels(scored, labels), OUT.workplace(spark, "late-labels")))


_CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM ev)"
_CUT = f"(SELECT date_trunc('day', min(ts)) + INTERVAL {OUT.BASELINE_DAYS} DAY FROM ev)"
_HIGH = f"avg(CASE WHEN y_prob >= {C.TIER_HIGH} THEN 1.0 ELSE 0.0 END)"


@register("monitor_shift", ops="N2,N3",
          doubles=["mean_prob", "high_rate", "baseline_mean_prob", "baseline_high_rate", "mean_shift"],
          sql=with_(EV + f""",
b AS (SELECT segment, count(*) AS baseline_n, avg(y_prob) AS baseline_mean_prob, {_HIGH} AS baseline_high_rate
  FROM ev WHERE ts < {_CUT} GROUP BY segment),
sw AS (SELECT date_trunc('day', ts) - to_days(CAST(j AS INTEGER)) AS ws, segment, y_prob FROM ev, range(0, 7) t(j) WHERE ts >= {_CUT}),
g AS (SELECT ws, segment, count(*) AS n, avg(y_prob) AS mean_prob, {_HIGH} AS high_rate FROM sw
  WHERE ws + INTERVAL 7 DAY <= {_CLOSED} GROUP BY ws, segment)""",
                    f"""SELECT strftime(ws, {FMT}) AS window_start, strftime(ws + INTERVAL 7 DAY, {FMT}) AS window_end, segment, n,
  mean_prob, high_rate, baseline_n, baseline_mean_prob, baseline_high_rate, mean_prob - baseline_mean_prob AS mean_shift,
  abs(mean_prob - baseline_mean_prob) > {C.MEAN_PROB_SHIFT} AS mean_shift_alert,
  (high_rate >= {C.HIGH_RATE_FACTOR} * baseline_high_rate OR high_rate <= baseline_high_rate / {C.HIGH_RATE_FACTOR}) AS high_rate_alert
FROM g JOIN b USING (segment)"""))
def q_shift(spark, sf_dir):
    """A stored baseline of the first days; the stream of the later days is compared with it window by window."""
    ev = MON.batch_events(spark, sf_dir)
    place = OUT.workplace(spark, "shift")
    start = F.date_trunc("day", F.lit(ev.agg(F.min("ts")).first()[0]).cast("timestamp_ntz")).cast("timestamp_ntz")
    cut = start + F.expr(f"interval {OUT.BASELINE_DAYS} days")
    OUT.baseline_table(ev.where(F.col("ts") < cut)).write.parquet(f"{place}/baseline")
    later = MON.score_events(_stream(spark, sf_dir)).where(F.col("ts") >= cut)
    return OUT.run_to_files(OUT.shift_windows(later, spark.read.parquet(f"{place}/baseline")), place)


@register("monitor_segments_stream", ops="N5", doubles=["flag_rate", "overall_flag_rate", "relative_deviation"],
          sql=with_(WEEKS + f""",
sg AS (SELECT ws, segment, count(*) AS n, sum(y_pred) AS flagged FROM wk WHERE ws + INTERVAL 7 DAY <= {_CLOSED} GROUP BY ws, segment),
tt AS (SELECT ws, sum(n) AS n_all, sum(flagged) AS flagged_all FROM sg GROUP BY ws),
dv AS (SELECT s.ws, segment, n, flagged / n AS flag_rate, flagged_all / n_all AS overall FROM sg s JOIN tt t ON s.ws = t.ws)""",
                    f"""SELECT strftime(ws, {FMT}) AS week_start, segment, n, flag_rate, overall AS overall_flag_rate,
  CASE WHEN overall > 0 THEN abs(flag_rate - overall) / overall ELSE 0.0 END AS relative_deviation,
  (CASE WHEN overall > 0 THEN abs(flag_rate - overall) / overall ELSE 0.0 END) > {C.SEGMENT_FLAG_DEVIATION} AS alert FROM dv"""))
def q_segments_stream(spark, sf_dir):
    counts = OUT.closed_segment_weeks(MON.score_events(_stream(spark, sf_dir)))
    seg = OUT.run_segment_upserts(counts, OUT.workplace(spark, "segments"))
    return MON.segment_deviation(seg)


_MONTHS = CASES + f""",
mc AS (SELECT *, strftime(ts, '%Y-%m') AS month, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred FROM cases
  WHERE date_trunc('month', ts) + INTERVAL 1 MONTH <= (SELECT max(ts) - INTERVAL 1 DAY FROM cases)),
ma AS (SELECT month, 'score_bin' AS attribute, CAST({_bin_idx()} AS VARCHAR) AS value, y_prob, escalated, y_pred FROM mc
  UNION ALL SELECT month, 'region', region, y_prob, escalated, y_pred FROM mc
  UNION ALL SELECT month, 'customer_type', customer_type, y_prob, escalated, y_pred FROM mc),
mm AS (SELECT month, attribute, value, count(*) AS n, sum(y_prob) AS predicted, CAST(sum(escalated) AS BIGINT) AS n_pos,
  {confusion_sql()} FROM ma WHERE value IS NOT NULL GROUP BY ALL)"""


def _closed_months(spark, sf_dir):
    orders = _stream(spark, sf_dir, "orders")
    rows = OUT.month_rows(CS.cases_of(orders, CS.case_dimensions(spark, sf_dir)), ATTRIBUTES)
    return OUT.run_to_files(OUT.closed_months(rows), OUT.workplace(spark, "months"))


@register("monthly_calibration", ops="N6", doubles=["predicted_rate", "actual_rate", "gap"],
          sql=with_(_MONTHS + """,
mp AS (SELECT month, attribute, value, n, floor(predicted / n * 1e6 + 1e-3) / 1e6 AS predicted_rate,
  floor(n_pos / n * 1e6 + 1e-3) / 1e6 AS actual_rate FROM mm)""",
                    f"""SELECT month, attribute, value, n, predicted_rate, actual_rate, predicted_rate - actual_rate AS gap,
  round(abs(predicted_rate - actual_rate), 6) > {C.CALIBRATION_DRIFT} AS alert FROM mp"""))
def q_monthly_calibration(spark, sf_dir):
    return OUT.month_calibration(_closed_months(spark, sf_dir))


@register("monthly_fairness", ops="N8", doubles=["min_tpr", "max_tpr", "tpr_ratio", "min_fpr", "max_fpr"],
          sql=with_(_MONTHS + f""",
mr AS (SELECT month, attribute, {RECALL} AS tpr, {FPR} AS fpr FROM mm WHERE attribute IN ('region', 'customer_type')),
mf AS (SELECT month, attribute, count(*) AS groups, min(tpr) AS min_tpr, max(tpr) AS max_tpr, min(fpr) AS min_fpr,
  max(fpr) AS max_fpr FROM mr GROUP BY month, attribute)""",
                    f"""SELECT month, attribute, groups, min_tpr, max_tpr,
  CASE WHEN max_tpr > 0 THEN min_tpr / max_tpr ELSE 0.0 END AS tpr_ratio,
  (CASE WHEN max_tpr > 0 THEN min_tpr / max_tpr ELSE 0.0 END) < {C.FOUR_FIFTHS} AS violates_80_rule, min_fpr, max_fpr FROM mf"""))
def q_monthly_fairness(spark, sf_dir):
    return OUT.month_fairness(_closed_months(spark, sf_dir), ATTRIBUTES)
