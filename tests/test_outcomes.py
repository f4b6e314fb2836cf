"""Stream-stream labels, idempotent segment sink, stored baseline and calendar months on small frames."""
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as ENTRY
from scripts.check_oracle import TABLES, digest, norm
from triagekit.streaming import outcomes as OUT

DAY = dt.datetime(2024, 3, 4)


def at(days, hours=0):
    return DAY + dt.timedelta(days=days, hours=hours)


def files(spark, folder, frames, schema):
    """A file stream that hands out one frame a trigger, in order."""
    import os
    import time
    for i, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1 if i + 1 < len(frames) else 0)
    assert os.path.isdir(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.mark.parametrize("name", ["monitor_late_labels", "monitor_shift", "monitor_segments_stream", "monthly_calibration",
                                  "monthly_fairness"])
def test_stream_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = ENTRY.queries()[name](spark, SF_SMALL).toPandas(), con.execute(ENTRY.oracle_sql()[name]).df()
    assert len(got) and digest(norm(got)) == digest(norm(want))


def test_labels_count_up_to_the_bound(spark, tmp_path):
    scored = [[(1, at(0), 1), (2, at(0), 1), (3, at(0), 0), (None, at(0), 1), (5, None, 1)], [(4, at(30), 1)]]
    labels = [[(1, at(14), 1), (3, at(-1), 1)], [(2, at(14, 1), 1), (4, at(30), 0), (1, at(3), 0), (5, at(1), 1)], [(9, at(60), 1)]]
    s = files(spark, tmp_path / "s", scored, "event_id long, ts timestamp_ntz, y_pred int")
    lab = files(spark, tmp_path / "l", labels, "event_id long, label_ts timestamp_ntz, escalated int")
    got = OUT.run_to_files(OUT.with_labels(s, lab), str(tmp_path / "run"))
    streamed = {tuple(r) for r in got.select("event_id", "escalated").collect()}
    batch = OUT.with_labels(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "l")))
    allowed = {tuple(r) for r in batch.select("event_id", "escalated").collect()}
    # the label of case 1 on day 14 counts, that of case 2 an hour later does not, one before its case neither
    assert allowed == {(1, 1), (1, 0), (4, 0)}
    assert {(1, 1), (4, 0)} <= streamed <= allowed


def test_join_state_is_dropped(spark, tmp_path):
    days = [[(100 * d + i, at(20 * d), 1) for i in range(5)] for d in range(4)]
    s = files(spark, tmp_path / "s", days, "event_id long, ts timestamp_ntz, y_pred int")
    lab = files(spark, tmp_path / "l", [[(e, t, 1) for e, t, _ in rows] for rows in days], "event_id long, label_ts timestamp_ntz, escalated int")
    out = OUT.with_labels(s, lab)
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "sink")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.schema(out.schema).parquet(str(tmp_path / "sink")).count() == 20
    assert held[-1] < 40 and held[-1] <= max(held)


def test_segment_sink_survives_replay(spark, tmp_path):
    rows = [[(i, at(d), "a" if i % 2 else "b", i % 3 == 0) for i in range(12)] for d in (0, 8, 16, 24)]
    frames = [[(e, t, s, int(p)) for e, t, s, p in r] for r in rows]
    stream = files(spark, tmp_path / "in", frames, "event_id long, ts timestamp_ntz, segment string, y_pred int")
    counts = OUT.closed_segment_weeks(stream)
    place = str(tmp_path / "run")
    first = sorted(map(str, OUT.run_segment_upserts(counts, place).collect()))
    assert len(first) == 6                                      # the last week stays open
    schema = counts.schema
    import glob
    folder = sorted(f for f in glob.glob(f"{place}/sink/batch=*"))[-1]
    again = spark.createDataFrame(spark.read.schema(schema).parquet(folder).collect(), schema)
    OUT.write_batch(again, int(folder.split("=")[1]), f"{place}/sink")
    assert sorted(map(str, OUT.latest_segments(spark, f"{place}/sink", schema).collect())) == first
    batch = spark.read.parquet(str(tmp_path / "in"))
    want = OUT.closed_segment_weeks(batch).where(F.col("w.end") <= F.to_timestamp(F.lit("2024-03-27")))
    assert sorted((r.n, r.flagged, r.segment) for r in want.collect()) == sorted(
        (r.n, r.flagged, r.segment) for r in OUT.latest_segments(spark, f"{place}/sink", schema).collect())


def test_shifted_second_period_raises_the_alert(spark):
    def rows(day, score, n=20):
        return [(at(day), score, "night") for _ in range(n)]
    schema = "ts timestamp_ntz, y_prob double, segment string"
    base = OUT.baseline_table(spark.createDataFrame(rows(0, 0.3) + rows(1, 0.7), schema))
    same = OUT.shift_windows(spark.createDataFrame(rows(20, 0.3) + rows(20, 0.7), schema), base).collect()
    high = OUT.shift_windows(spark.createDataFrame(rows(20, 0.9), schema), base).collect()
    assert same and not any(r.mean_shift_alert or r.high_rate_alert for r in same)
    assert high and all(r.mean_shift_alert and r.high_rate_alert and r.baseline_n == 40 for r in high)
    assert OUT.shift_windows(spark.createDataFrame([], schema), base).count() == 0


def test_months_close_by_event_time(spark, tmp_path):
    schema = "ts timestamp_ntz, region string, y_prob double, escalated int"
    feb, mar = dt.datetime(2024, 2, 29, 23, 59), dt.datetime(2024, 3, 1)
    frames = [[(feb, "n", 0.9, 1), (feb, None, 0.1, 0), (mar, "n", 0.9, 0)],
              [(dt.datetime(2024, 3, 15), "s", 0.2, 1)],          # closes February
              [(feb, "n", 0.5, 1), (dt.datetime(2024, 5, 1), "n", 0.5, 0)]]   # the first is too late; closes March
    stream = files(spark, tmp_path / "in", frames, schema)
    got = OUT.run_to_files(OUT.closed_months(OUT.month_rows(stream, ["region"])), str(tmp_path / "run"))
    rows = {(r.month, r.attribute, r.value): (r.n, round(r.predicted, 6), r.n_pos, r.tp, r.fp, r.fn, r.tn) for r in got.collect()}
    assert rows[("2024-02", "region", "n")] == (1, 0.9, 1, 1, 0, 0, 0)
    assert rows[("2024-03", "region", "n")] == (1, 0.9, 0, 0, 1, 0, 0) and rows[("2024-03", "region", "s")][3:] == (0, 0, 1, 0)
    assert rows[("2024-02", "score_bin", "0")] == (1, 0.1, 0, 0, 0, 0, 1)
    assert not any(m == "2024-05" for m, _, _ in rows)
    gaps = {(r.month, r.value): r.alert for r in OUT.month_calibration(got.where("attribute = 'region'")).collect()}
    assert gaps[("2024-02", "n")] and gaps[("2024-03", "n")]
