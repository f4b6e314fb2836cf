"""Case tables built from the test schema, and the modelling preparation (A2).

``cases`` maps the order star schema onto the case shape: one row per order,
customer = group, order priority = escalation level, nation = issue category,
plus a deterministic stand-in score ``y_prob`` and a customer-disjoint
``fold``. Dimension joins are broadcast behind a row-count check; the
orders x customer join is a keyed shuffle join (AQE splits skewed keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions.text import clean_text
from .tables import read_table


def case_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (customer_type, tenure_type, region, issue_category)."""
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # keyed joins without hints: AQE broadcasts the side it measures to be small
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    geo = geo.select("n_nationkey", F.col("r_name").alias("region"),
                     F.col("n_name").alias("issue_category"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return (cust.join(geo, cust.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey"),
                    F.col("c_mktsegment").alias("customer_type"),
                    F.when(F.col("c_acctbal") >= 4500, "Long-term").otherwise("New").alias("tenure_type"),
                    "region", "issue_category"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured + scored case table (raw view: sentiment keeps its NULLs)."""
    return cases_of(read_table(spark, sf_dir, "orders"), case_dimensions(spark, sf_dir))


def cases_of(orders: DataFrame, dims: DataFrame) -> DataFrame:
    """The case view of an orders frame, batch or streaming, joined with its static dimensions."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    j = o.join(dims, o.o_custkey == dims.c_custkey)
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    return j.select(
        k.alias("case_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ts"),
        F.when(prio == "1-URGENT", 3).when(prio == "2-HIGH", 2)
         .when(prio == "3-MEDIUM", 1).otherwise(0).alias("escalation_level"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("escalated"),
        "customer_type", "tenure_type",
        F.when(k % 2 == 0, "Smart").otherwise("Standard").alias("meter_type"),
        "region", "issue_category",
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "F", "Negative")
         .when(F.col("o_orderstatus") == "O", "Neutral").otherwise("Positive").alias("sentiment"),
        (F.col("o_totalprice") / F.lit(5e5)).alias("emotion_intensity"),
        (((k * 31) % 720).cast("double") / F.lit(1e1)).alias("resolution_time"),
        # the label lifts the score of four rows in five, so that a tuned threshold fills all four outcomes
        (((k * 7919) % 59999 + F.when(prio.isin("1-URGENT", "2-HIGH") & (k % 5 != 3), 40000).otherwise(0))
         .cast("double") / F.lit(1e5)).alias("y_prob"),
        (F.col("o_custkey") % C.N_FOLDS).cast("int").alias("fold"),
    )


def prepare(df: DataFrame, ts_col: str = "ts", text_col: str | None = None) -> DataFrame:
    """Modelling view (A2, B1-B5): target, calendar fields, imputed sentiment, clean text.

    One projection; the raw frame keeps its NULLs for profiling.
    """
    cols = [c for c in df.columns if c not in ("sentiment",)]
    out = [F.col(c) for c in cols]
    out.append(F.coalesce(F.col("sentiment"), F.lit(C.UNKNOWN)).alias("sentiment"))
    if "escalated" not in df.columns and "escalation_level" in df.columns:
        out.append((F.col("escalation_level") >= C.POSITIVE_LEVEL).cast("int").alias("escalated"))
    out += [cal.hour(ts_col).alias("hour"), cal.day_of_week(ts_col).alias("day_of_week"),
            cal.month(ts_col).alias("month")]
    if text_col:
        out.append(clean_text(text_col).alias(C.TEXT_COL_CLEAN))
    return df.select(*out)


def model_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(cases(spark, sf_dir))


def feature_frame(df: DataFrame) -> DataFrame:
    """Leakage guard (B7): drop identifiers, target sources and leakage columns."""
    return df.drop(*[c for c in C.EXCLUDE_COLS if c in df.columns])


def text_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text case table: documents with labels (toxic = target, source = group)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return docs.join(lab, "doc_id").select(
        "doc_id", F.col("source").alias("customer_id"), "lang", "text",
        F.col("toxic").alias("escalated"), clean_text("text").alias(C.TEXT_COL_CLEAN))
