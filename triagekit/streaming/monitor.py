"""Production monitoring (N1-N9) as windowed aggregations.

Every monitor is a function of a DataFrame with ``ts``, ``escalated``,
``y_prob`` (and ``segment`` where needed). The same function runs on a batch
frame or on a streaming frame from ``readStream``: windows come from
``window()``, late data is bounded by ``withWatermark``, and the training
baseline enters as two scalars from one aggregate row. Logic that needs
the sequence of closed periods (two consecutive weeks) runs over the sink
output in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import metrics as M
from ..operators import features as FE
from ..sources.tables import read_table

TS_FMT = "yyyy-MM-dd HH:mm:ss"
SLIDE_WINDOW = ("7 days", "1 day")
WEEK = "7 days"
WATERMARK = "1 day"
# Decision threshold of the monitored score.
MONITOR_THRESHOLD = 0.5
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def daypart(ts) -> F.Column:
    h = F.hour(ts)
    return (F.when(h < 6, "night").when(h < 12, "morning").when(h < 18, "afternoon").otherwise("evening"))


def score_events(ev: DataFrame, threshold: float = MONITOR_THRESHOLD) -> DataFrame:
    """Monitored rows: label = error event, score, decision, segment.

    The score is defined as min(value, 100) / 100: values above 100 saturate at
    a score of 1, and no row is dropped.
    """
    y_prob = F.least(F.col("value"), F.lit(1e2)) / F.lit(1e2)
    return ev.select("event_id", "ts", (F.col("event_type") == "error").cast("int").alias("escalated"),
                     y_prob.alias("y_prob"), (y_prob >= F.lit(threshold)).cast("int").alias("y_pred"),
                     daypart(F.col("ts")).alias("segment"))


def baseline(scored: DataFrame, high: float = C.TIER_HIGH) -> tuple[float, float]:
    """Training baseline (one aggregate row): mean score and HIGH-tier rate."""
    r = scored.agg(F.avg("y_prob").alias("m"), F.avg((F.col("y_prob") >= high).cast("double")).alias("h")).first()
    return float(r["m"]), float(r["h"])


def _fmt(c) -> F.Column:
    return F.date_format(c, TS_FMT)


def _watermarked(scored: DataFrame) -> DataFrame:
    """Event time for streams: watermarks need an instant type, so the naive time is read as UTC."""
    return scored.withColumn("ts", F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())) \
        .withWatermark("ts", WATERMARK)


def window_rates(scored: DataFrame, base: tuple[float, float], streaming: bool = False,
                 high: float = C.TIER_HIGH) -> DataFrame:
    """Sliding 7-day windows: flag rate (N1), mean score vs baseline (N2), HIGH-tier rate vs baseline."""
    x = _watermarked(scored) if streaming else scored
    g = x.groupBy(F.window("ts", *SLIDE_WINDOW).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("y_pred").cast("double")).alias("flag_rate"),
        F.avg("y_prob").alias("mean_prob"), F.avg((F.col("y_prob") >= high).cast("double")).alias("high_risk_rate"))
    g = g.withColumn("baseline_mean_prob", F.lit(base[0])).withColumn("baseline_high_rate", F.lit(base[1]))
    lo, hi = C.FLAG_RATE_BAND
    return g.select(_fmt("w.start").alias("window_start"), _fmt("w.end").alias("window_end"), "n", "flag_rate",
                    "mean_prob", "high_risk_rate", "baseline_mean_prob", "baseline_high_rate",
                    ((F.col("flag_rate") < lo) | (F.col("flag_rate") > hi)).alias("flag_alert"),
                    (F.abs(F.col("mean_prob") - F.col("baseline_mean_prob")) > C.MEAN_PROB_SHIFT).alias("mean_shift_alert"),
                    ((F.col("high_risk_rate") >= C.HIGH_RATE_FACTOR * F.col("baseline_high_rate")) |
                     (F.col("high_risk_rate") <= F.col("baseline_high_rate") / C.HIGH_RATE_FACTOR)).alias("high_rate_alert"))


def weekly_outcomes(scored: DataFrame, streaming: bool = False) -> DataFrame:
    """Tumbling weeks: observed positive rate and recall estimate with alert flags (N4, per week)."""
    x = _watermarked(scored) if streaming else scored
    g = x.groupBy(F.window("ts", WEEK).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("escalated").cast("long")).alias("n_pos"), *M.confusion_aggs())
    lo, hi = C.OBSERVED_RATE_BAND
    obs = F.col("n_pos") / F.col("n")
    return g.select(_fmt("w.start").alias("week_start"), "n", "n_pos", obs.alias("observed_rate"),
                    M.recall().alias("recall"), ((obs < lo) | (obs > hi)).alias("rate_alert"),
                    (M.recall() < C.RECALL_FLOOR).alias("recall_alert"))


def sustained(weekly: DataFrame) -> DataFrame:
    """Two-consecutive-week triggers over the closed weeks (batch over the sink; one row per week)."""
    w = Window.orderBy("week_start")
    return weekly.select("*", F.coalesce(F.lag("rate_alert").over(w), F.lit(False)).alias("_pr"),
                         F.coalesce(F.lag("recall_alert").over(w), F.lit(False)).alias("_pc")).select(
        "week_start", "n", "n_pos", "observed_rate", "recall", "rate_alert", "recall_alert",
        (F.col("rate_alert") & F.col("_pr")).alias("rate_alert_2w"),
        (F.col("recall_alert") & F.col("_pc")).alias("recall_alert_2w"))


def segment_rates(scored: DataFrame, streaming: bool = False) -> DataFrame:
    """Per week and segment: flag rate vs the week's overall rate, alert at 20% relative deviation."""
    x = _watermarked(scored) if streaming else scored
    seg = x.groupBy(F.window("ts", WEEK).alias("w"), "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y_pred").cast("long")).alias("flagged"))
    return seg


def segment_deviation(seg: DataFrame) -> DataFrame:
    """Overall rate per week from the segment table (small), relative deviation and alert."""
    tot = seg.groupBy("w").agg(F.sum("n").alias("n_all"), F.sum("flagged").alias("flagged_all"))
    j = seg.join(tot, "w")
    rate = F.col("flagged") / F.col("n")
    overall = F.col("flagged_all") / F.col("n_all")
    dev = F.when(overall > 0, F.abs(rate - overall) / overall).otherwise(F.lit(0.0))
    return j.select(_fmt("w.start").alias("week_start"), "segment", "n", rate.alias("flag_rate"),
                    overall.alias("overall_flag_rate"), dev.alias("relative_deviation"),
                    (dev > C.SEGMENT_FLAG_DEVIATION).alias("alert"))


def calibration_drift(scored: DataFrame, edges=C.CALIBRATION_EDGES) -> DataFrame:
    """Per week and right-closed score bin: actual rate vs the all-period rate; alert above 5 points."""
    b = scored.select(F.window("ts", WEEK).alias("w"), M.right_closed_bin_index("y_prob", edges).alias("bin"),
                      "escalated").filter(F.col("bin").isNotNull())
    per = b.groupBy("w", "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("escalated").cast("double")).alias("actual_rate"))
    base = b.groupBy("bin").agg(F.avg(F.col("escalated").cast("double")).alias("baseline_rate"))
    j = per.join(F.broadcast(base), "bin")  # one row per bin
    d = F.abs(F.col("actual_rate") - F.col("baseline_rate"))
    return j.select(_fmt("w.start").alias("week_start"), "bin", "n", "actual_rate", "baseline_rate",
                    d.alias("drift"), (d > C.CALIBRATION_DRIFT).alias("alert"))


def vocabulary_drift(new_text: DataFrame, period_col: str, vocab_terms: DataFrame, text_col: str = "text",
                     spec: FE.TfidfSpec = FE.TfidfSpec()) -> DataFrame:
    """Share of new tokens outside the training vocabulary per period; alert above 20%."""
    uni = FE.TfidfSpec(spec.max_features, 1, spec.min_df, spec.max_df, spec.sublinear_tf, spec.strip_accents)
    tok = FE.with_terms(new_text.select(period_col, text_col), text_col, uni, "_t").select(
        period_col, F.explode("_t").alias("term"))
    v = vocab_terms.select("term", F.lit(1).alias("_in"))
    # the vocabulary is bounded by max_features; without that bound the planner picks the join
    j = tok.join(F.broadcast(v) if spec.max_features else v, "term", "left")
    g = j.groupBy(period_col).agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("_in").isNull()).alias("n_oov"))
    r = F.col("n_oov") / F.col("n_tokens")
    return g.select(period_col, "n_tokens", "n_oov", r.alias("oov_rate"), (r > C.OOV_LIMIT).alias("alert"))


def fairness_audit(scored: DataFrame) -> DataFrame:
    """Per week: TPR by segment, min/max ratio and the 80% rule."""
    g = scored.groupBy(F.window("ts", WEEK).alias("w"), "segment").agg(*M.confusion_aggs())
    g = g.select("w", "segment", M.recall().alias("tpr"), M.fpr().alias("fpr"))
    a = g.groupBy("w").agg(F.min("tpr").alias("min_tpr"), F.max("tpr").alias("max_tpr"),
                           F.min("fpr").alias("min_fpr"), F.max("fpr").alias("max_fpr"))
    ratio = M.safe_div("min_tpr", "max_tpr")
    return a.select(_fmt("w.start").alias("week_start"), "min_tpr", "max_tpr", ratio.alias("tpr_ratio"),
                    (ratio < C.FOUR_FIFTHS).alias("violates_80_rule"), "min_fpr", "max_fpr")


def retrain_triggers(weekly: DataFrame, oov_rate: float, quarter_weeks: int = 13) -> DataFrame:
    """One row per week with the retraining conditions."""
    s = sustained(weekly)
    w = Window.orderBy("week_start")  # one row per week
    s = s.withColumn("week_index", F.row_number().over(w))
    return s.select("week_start",
                    (F.abs(F.col("observed_rate") - C.TRAINING_BASE_RATE) > C.BASE_RATE_CHANGE).alias("rate_change"),
                    F.col("recall_alert_2w").alias("recall_drop_2w"),
                    F.lit(oov_rate > C.OOV_LIMIT).alias("vocabulary_drift"),
                    ((F.col("week_index") % quarter_weeks) == 0).alias("scheduled_retrain"))


# ----------------------------------------------------------------------------------- streaming

def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Events as a stream (file source, explicit schema)."""
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def start_window_monitor(spark: SparkSession, stream: DataFrame, base: tuple[float, float], name: str,
                         checkpoint: str, sink: str = "memory", output_mode: str = "append"):
    """Start N1-N3 on a stream; windows are emitted once the watermark closes them."""
    scored = score_events(stream)
    q = window_rates(scored, base, streaming=True)
    w = q.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if sink == "memory":
        w = w.format("memory").queryName(name)
    else:
        w = w.format("parquet").option("path", sink)
    return w.start()


def start_segment_monitor(spark: SparkSession, stream: DataFrame, sink_path: str, checkpoint: str):
    """Start N5 on a stream: running segment table, deviation computed in foreachBatch.

    Each batch carries the complete (week, segment) table, so the sink is
    overwritten: replaying a batch after a failure writes the same result.
    """
    scored = score_events(stream)
    seg = segment_rates(scored, streaming=True)

    def emit(batch: DataFrame, batch_id: int):
        segment_deviation(batch).write.mode("overwrite").parquet(sink_path)

    return (seg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(emit).start())


def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_events(read_table(spark, sf_dir, "events"))
