"""Scans and sinks.

Parquet is the native input; the raw case file format (CSV with quoted,
multi-line text) is read with an explicit schema, never inferred.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Raw case-file schema (13 columns).
RAW_CASE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("email_body_text", T.StringType(), True),
    T.StructField("customer_type", T.StringType(), True),
    T.StructField("tenure_type", T.StringType(), True),
    T.StructField("meter_type", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("issue_category", T.StringType(), True),
    T.StructField("sentiment", T.StringType(), True),
    T.StructField("emotion_intensity", T.DoubleType(), True),
    T.StructField("escalation_level", T.IntegerType(), True),
    T.StructField("resolution_time", T.DoubleType(), True),
    T.StructField("manual_annotation", T.StringType(), True),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_case_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CASE_SCHEMA) -> DataFrame:
    """Raw case CSV (A1): header row, quoted text with embedded commas/newlines."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("escape", '"').option("mode", "PERMISSIVE")
            .csv(path))


def read_case_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_CASE_SCHEMA, ts_col: str = "timestamp",
                    header: bool = True) -> DataFrame:
    """Raw case CSV with the broken rows kept (A1, B2): the schema's columns, ``corrupt_record`` and ``problem``.

    ``problem`` is null for a good row, ``malformed`` for a row with too few or
    too many fields or a number that is none (its whole text is in
    ``corrupt_record``), ``bad_timestamp`` for a time that is no time. An empty
    time is missing, not bad. Times are read without a zone.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name == ts_col else f.dataType, True) for f in schema]
                       + [T.StructField("corrupt_record", T.StringType(), True)])
    r = (spark.read.schema(raw).option("header", header).option("multiLine", True).option("escape", '"')
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_record").csv(path))
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    bad_ts = F.col(ts_col).isNotNull() & ts.isNull()
    problem = F.when(F.col("corrupt_record").isNotNull(), "malformed").when(bad_ts, "bad_timestamp")
    # the text of a bad time goes with the quarantined row
    record = F.when(F.col("corrupt_record").isNull() & bad_ts, F.col(ts_col)).otherwise(F.col("corrupt_record"))
    return r.select(*[ts.alias(ts_col) if f.name == ts_col else F.col(f.name) for f in schema],
                    record.alias("corrupt_record"), problem.alias("problem"))


def quarantine(lines: DataFrame, good_path: str, bad_path: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and broken rows as two Parquet tables, each reread; every column is parsed, so every fault is seen."""
    good = lines.where("problem is null").drop("corrupt_record", "problem")
    lines.where("problem is not null").write.mode("overwrite").parquet(bad_path)
    good.write.mode("overwrite").parquet(good_path)
    spark = lines.sparkSession
    return spark.read.parquet(good_path), spark.read.parquet(bad_path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Result sink (A4/A6): parquet by default, CSV/JSON on request."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Nested summary sink (A5): a small struct-typed frame written as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
