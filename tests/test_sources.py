"""Scans and sinks: explicit-schema case CSV with quoted multi-line text, parquet and JSON sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from triagekit.sources import tables as TB
from triagekit.sources.cases import feature_frame, prepare


def test_case_csv_roundtrip_and_prepare(spark):
    d = tempfile.mkdtemp(prefix="tk-csv-")
    path = os.path.join(d, "cases.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("customer_id,timestamp,email_body_text,customer_type,tenure_type,meter_type,region,"
                "issue_category,sentiment,emotion_intensity,escalation_level,resolution_time,manual_annotation\n")
        f.write('CUST1,2024-03-04 10:15:00,"Hello, my ""meter""\nis broken!",Domestic,New,Smart,Wales,Meter,,0.7,3,12.5,\n')
        f.write('CUST2,2024-03-05 23:00:00,Bill too high,Commercial,Long-term,Standard,England,Billing,Negative,0.1,1,3.0,x\n')
    df = TB.read_case_csv(spark, path)
    rows = df.orderBy("customer_id").collect()
    assert len(rows) == 2
    assert rows[0]["email_body_text"] == 'Hello, my "meter"\nis broken!'
    p = prepare(df, ts_col="timestamp", text_col="email_body_text").orderBy("customer_id").collect()
    assert p[0]["escalated"] == 1 and p[1]["escalated"] == 0
    assert p[0]["sentiment"] == "Unknown"
    assert p[0]["hour"] == 10 and p[0]["day_of_week"] == 0 and p[0]["month"] == 3
    assert p[0]["email_body_text_clean"] == "hello my meter is broken"
    feats = feature_frame(prepare(df, ts_col="timestamp", text_col="email_body_text")).columns
    assert "resolution_time" not in feats and "customer_id" not in feats and "escalation_level" not in feats


def test_sinks(spark):
    d = tempfile.mkdtemp(prefix="tk-sink-")
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("k"))
    TB.write_table(df, os.path.join(d, "t"), partition_by=["k"])
    assert spark.read.parquet(os.path.join(d, "t")).count() == 10
    s = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.lit("x").alias("b")).alias("summary"))
    TB.write_summary(s, os.path.join(d, "j"))
    assert spark.read.json(os.path.join(d, "j")).first()["summary"]["b"] == "x"
