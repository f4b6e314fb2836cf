"""Monitors that need more than one stream, a stored baseline or calendar months.

* Late labels: the scored stream meets the label stream in an interval join with
  a watermark on both sides, so that a label counts up to ``LABEL_DAYS`` after its
  case and the state of older cases is dropped (N4).
* Baselines: a table of a training period, stored once, that closed windows of
  the later stream are joined with (N2, N3).
* Segments: closed weeks leave the state in append mode and reach the sink as
  folders named by batch, so a replayed batch writes what it wrote before (N5).
* Months: state per calendar month and attribute value, closed by event time;
  predicted against observed rates and true-positive rates (N6, N8).

Naive event times are read as UTC instants, whatever the session's time zone,
since watermarks need instants. Sinks are files; streams run with
``availableNow`` and restart from their checkpoint. A row with a null time or
key is in no window, month or match.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..functions import metrics as M
from ..session import ensure_checkpoint_dir
from .monitor import SLIDE_WINDOW, TS_FMT, WATERMARK, WEEK

LABEL_DAYS = 14
BASELINE_DAYS = 10


def instant(ts: Column) -> Column:
    """A naive time as the instant it names in UTC."""
    return F.to_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def shown(ts: Column, fmt: str = TS_FMT) -> Column:
    """An instant as UTC text."""
    return F.date_format(F.from_utc_timestamp(ts, F.current_timezone()), fmt)


def workplace(spark: SparkSession, name: str) -> str:
    """A fresh folder for a run's sink and checkpoint, shared by all executors."""
    return f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"


def run_to_files(out: DataFrame, place: str) -> DataFrame:
    """Run a stream over what is there, in append mode, and read its sink."""
    (out.writeStream.outputMode("append").format("parquet").option("path", f"{place}/sink")
     .option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return out.sparkSession.read.schema(out.schema).parquet(f"{place}/sink")


# --- late labels (N4) ------------------------------------------------------------------------

def label_stream(events: DataFrame) -> DataFrame:
    """``event_id, label_ts, escalated``: labels of the events table arrive up to 20 days after their event."""
    late = F.make_dt_interval(hours=F.col("event_id") * 37 % 480)
    return events.select("event_id", (F.col("ts") + late).alias("label_ts"),
                         (F.col("event_type") == "error").cast("int").alias("escalated"))


def with_labels(scored: DataFrame, labels: DataFrame, days: int = LABEL_DAYS) -> DataFrame:
    """Scored rows (event_id, ts, y_pred) with the label that arrives from 0 to ``days`` days after them.

    The same on batch and on streaming frames; on streams both watermarks and
    the time bound let Spark drop state.
    """
    s = (scored.select("event_id", instant(F.col("ts")).alias("ts"), "y_pred").withWatermark("ts", WATERMARK))
    lab = (labels.select(F.col("event_id").alias("label_id"), instant(F.col("label_ts")).alias("label_ts"), "escalated")
           .withWatermark("label_ts", WATERMARK))
    within = (F.col("event_id") == F.col("label_id")) & (F.col("label_ts") >= F.col("ts")) & \
        (F.col("label_ts") <= F.col("ts") + F.expr(f"interval {days} days"))
    return s.join(lab, within).select("event_id", "ts", "label_ts", "y_pred", "escalated")


def labelled_weeks(matched: DataFrame) -> DataFrame:
    """Weeks of the scored time: labels in time, observed rate and recall with their alerts."""
    g = matched.groupBy(F.window("ts", WEEK).alias("w")).agg(
        F.count(F.lit(1)).alias("n_labelled"), F.sum(F.col("escalated").cast("long")).alias("n_pos"),
        F.max(F.datediff("label_ts", "ts")).alias("latest_days"), *M.confusion_aggs())
    lo, hi = C.OBSERVED_RATE_BAND
    rate = F.col("n_pos") / F.col("n_labelled")
    return g.select(shown(F.col("w.start")).alias("week_start"), "n_labelled", "n_pos", rate.alias("observed_rate"),
                    M.recall().alias("recall"), "latest_days", ((rate < lo) | (rate > hi)).alias("rate_alert"),
                    (M.recall() < C.RECALL_FLOOR).alias("recall_alert"))


# --- training baseline (N2, N3) --------------------------------------------------------------

def baseline_table(training: DataFrame, high: float = C.TIER_HIGH) -> DataFrame:
    """Per segment of a training period: rows, mean score and share of HIGH scores."""
    return training.groupBy("segment").agg(
        F.count(F.lit(1)).alias("baseline_n"), F.avg("y_prob").alias("baseline_mean_prob"),
        F.avg((F.col("y_prob") >= high).cast("double")).alias("baseline_high_rate"))


def shift_windows(scored: DataFrame, base: DataFrame, high: float = C.TIER_HIGH) -> DataFrame:
    """Sliding windows per segment against the stored baseline: mean shift and HIGH-rate alerts.

    ``scored`` must hold no row of the baseline's period. A segment without a
    baseline is not compared.
    """
    x = scored.withColumn("ts", instant(F.col("ts"))).withWatermark("ts", WATERMARK)
    g = x.groupBy(F.window("ts", *SLIDE_WINDOW).alias("w"), "segment").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_prob"),
        F.avg((F.col("y_prob") >= high).cast("double")).alias("high_rate"))
    shift = F.col("mean_prob") - F.col("baseline_mean_prob")
    factor = F.lit(C.HIGH_RATE_FACTOR)
    return g.join(base, "segment").select(
        shown(F.col("w.start")).alias("window_start"), shown(F.col("w.end")).alias("window_end"), "segment", "n",
        "mean_prob", "high_rate", "baseline_n", "baseline_mean_prob", "baseline_high_rate", shift.alias("mean_shift"),
        (F.abs(shift) > C.MEAN_PROB_SHIFT).alias("mean_shift_alert"),
        ((F.col("high_rate") >= factor * F.col("baseline_high_rate")) |
         (F.col("high_rate") <= F.col("baseline_high_rate") / factor)).alias("high_rate_alert"))


# --- segments with bounded state (N5) --------------------------------------------------------

def closed_segment_weeks(scored: DataFrame) -> DataFrame:
    """Week and segment counts that leave the state when the watermark closes the week."""
    x = scored.withColumn("ts", instant(F.col("ts"))).withWatermark("ts", WATERMARK)
    return x.groupBy(F.window("ts", WEEK).alias("w"), "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y_pred").cast("long")).alias("flagged"))


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """One folder a batch; writing it again replaces it, so a replay changes nothing."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def run_segment_upserts(counts: DataFrame, place: str) -> DataFrame:
    """Run the segment counts over what is there and read the latest row of every week and segment."""
    (counts.writeStream.outputMode("append").option("checkpointLocation", f"{place}/checkpoint")
     .foreachBatch(lambda b, i: write_batch(b, i, f"{place}/sink")).trigger(availableNow=True).start().awaitTermination())
    return latest_segments(counts.sparkSession, f"{place}/sink", counts.schema)


def latest_segments(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    value = F.max_by(F.struct("n", "flagged"), "batch")
    start = F.from_utc_timestamp("w.start", F.current_timezone()).alias("start")     # read as naive UTC from here on
    return rows.groupBy("w", "segment").agg(value.alias("v")).select(F.struct(start).alias("w"), "segment", "v.n", "v.flagged")


# --- calendar months (N6, N8) ----------------------------------------------------------------

MONTH_ROW = ("month string, attribute string, value string, n long, predicted double, n_pos long, "
             "tp long, fp long, fn long, tn long")
MONTH_STATE = "n long, predicted double, tp long, fp long, fn long, tn long"


def month_rows(cases: DataFrame, attributes: list[str], threshold: float = 0.5, edges=C.CALIBRATION_EDGES) -> DataFrame:
    """A row per case and attribute value, the score's bin being one attribute; ``ts`` is watermarked."""
    bin_ = M.right_closed_bin_index("y_prob", edges)
    pairs = F.array(F.struct(F.lit("score_bin").alias("attribute"), bin_.cast("string").alias("value")),
                    *[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in attributes])
    x = cases.withColumn("ts", instant(F.col("ts"))).withWatermark("ts", WATERMARK)
    return (x.select("ts", "y_prob", "escalated", (F.col("y_prob") >= threshold).cast("int").alias("y_pred"),
                     F.explode(pairs).alias("p"))
            .select("ts", shown(F.col("ts"), "yyyy-MM").alias("month"), "p.attribute", "p.value", "y_prob", "escalated", "y_pred")
            .where("value is not null and ts is not null"))


def batch_months(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("month", "attribute", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y_prob").alias("predicted"),
                 F.sum(F.col("escalated").cast("long")).alias("n_pos"), *M.confusion_aggs()))


def _month_end(month: str) -> int:
    return int((pd.Timestamp(month + "-01", tz="UTC") + pd.DateOffset(months=1)).timestamp() * 1000)


def _count_month(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    month, attribute, value = key
    if state.hasTimedOut:
        n, predicted, tp, fp, fn, tn = state.get
        state.remove()
        yield pd.DataFrame([[month, attribute, value, n, predicted, tp + fn, tp, fp, fn, tn]],
                           columns=[c.split()[0] for c in MONTH_ROW.split(", ")])
        return
    held = list(state.get) if state.exists else [0, 0.0, 0, 0, 0, 0]
    for f in frames:
        y, p = f["escalated"], f["y_pred"]
        new = (len(f), float(f["y_prob"].sum()), *(int(((y == a) & (p == b)).sum()) for a, b in ((1, 1), (0, 1), (1, 0), (0, 0))))
        held = [a + b for a, b in zip(held, new)]
    if _month_end(month) > state.getCurrentWatermarkMs():     # rows of a closed month are too late
        state.update(tuple(held))
        state.setTimeoutTimestamp(_month_end(month))


def closed_months(rows: DataFrame) -> DataFrame:
    """The streaming form of ``batch_months``: a month is emitted once the watermark passes its end, and its state goes."""
    return rows.groupBy("month", "attribute", "value").applyInPandasWithState(
        _count_month, MONTH_ROW, MONTH_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def month_calibration(months: DataFrame) -> DataFrame:
    """Per month and attribute value: predicted against observed rate, and the alert beyond 5 points."""
    def rate(c: str) -> Column:    # cut to 6 decimals, so that sums in another order give the same digits
        return F.floor(F.col(c) / F.col("n") * 1e6 + 1e-3) / 1e6

    p, a = rate("predicted"), rate("n_pos")
    return months.select("month", "attribute", "value", "n", p.alias("predicted_rate"), a.alias("actual_rate"),
                         (p - a).alias("gap"), (F.round(F.abs(p - a), 6) > C.CALIBRATION_DRIFT).alias("alert"))


def month_fairness(months: DataFrame, attributes: list[str]) -> DataFrame:
    """Per month and attribute: smallest and largest true- and false-positive rate, and the 80% rule."""
    g = (months.where(F.col("attribute").isin(attributes))
         .select("month", "attribute", M.recall().alias("tpr"), M.fpr().alias("fpr"))
         .groupBy("month", "attribute").agg(F.count(F.lit(1)).alias("groups"), F.min("tpr").alias("min_tpr"),
                                            F.max("tpr").alias("max_tpr"), F.min("fpr").alias("min_fpr"),
                                            F.max("fpr").alias("max_fpr")))
    ratio = M.safe_div("min_tpr", "max_tpr")
    return g.select("month", "attribute", "groups", "min_tpr", "max_tpr", ratio.alias("tpr_ratio"),
                    (ratio < C.FOUR_FIFTHS).alias("violates_80_rule"), "min_fpr", "max_fpr")
