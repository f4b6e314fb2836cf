"""Registered queries on stored sketches, broken input lines, signature folds and the Euclidean silhouette, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import silhouette as SIL
from ..operators import sketches as SK
from ..operators import splits as SP
from ..sources import tables as TB
from ..sources.cases import cases
from ..streaming.outcomes import workplace
from .registry import register
from .sql_cases import CASES, with_

_SIGNED = CASES + f""",
sg AS (SELECT customer_id, count(*) FILTER (WHERE escalated = 1) AS n_pos, count(*) FILTER (WHERE escalated = 0) AS n_neg
  FROM cases GROUP BY customer_id),
sf AS (SELECT customer_id, n_pos, n_neg, CAST((row_number() OVER (ORDER BY n_pos, n_neg,
  md5(CAST(customer_id AS VARCHAR) || ':{C.SEED}')) - 1) % {C.N_FOLDS} AS INTEGER) AS fold FROM sg)"""


@register("signature_folds", ops="J1", sql=with_(_SIGNED, "SELECT customer_id, n_pos, n_neg, fold FROM sf"))
def q_signature_folds(spark, sf_dir):
    return SP.signature_folds(cases(spark, sf_dir))


@register("signature_fold_balance", ops="J1,H1", doubles=["prevalence"],
          sql=with_(_SIGNED, """SELECT fold, count(*) AS n_groups, CAST(sum(n_pos + n_neg) AS BIGINT) AS n,
  sum(n_pos) / sum(n_pos + n_neg) AS prevalence FROM sf GROUP BY fold"""))
def q_signature_fold_balance(spark, sf_dir):
    n = F.sum(F.col("n_pos") + F.col("n_neg"))
    return SP.signature_folds(cases(spark, sf_dir)).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_groups"), n.alias("n"), (F.sum("n_pos") / n).alias("prevalence"))


@register("distinct_sketches", ops="D6",
          sql=with_(CASES, """SELECT CAST(year(ts) AS INTEGER) AS year, count(DISTINCT month(ts)) AS n_months,
  count(DISTINCT customer_id) AS n_customers, true AS within_bound, true AS union_equals_year FROM cases GROUP BY year(ts)"""))
def q_distinct_sketches(spark, sf_dir):
    """Monthly sketches of the customers, stored; the year's count from their union, beside the year's own sketch."""
    c = cases(spark, sf_dir).select("customer_id", F.year("ts").alias("year"), F.month("ts").alias("month"))
    path = f"{workplace(spark, 'sketches')}/months"
    TB.write_table(SK.distinct_sketches(c, ["year", "month"], "customer_id"), path)
    months = spark.read.parquet(path)
    union = SK.estimated(SK.united(months, ["year"]))
    whole = SK.estimated(SK.united(SK.distinct_sketches(c, ["year"], "customer_id"), ["year"]), "_whole")
    exact = c.groupBy("year").agg(F.countDistinct("month").alias("n_months"), F.countDistinct("customer_id").alias("n_customers"))
    off = F.abs(F.col("n_estimated") - F.col("n_customers"))
    return exact.join(union, "year").join(whole, "year").select(
        "year", "n_months", "n_customers", (off <= SK.error_bound() * F.col("n_customers")).alias("within_bound"),
        (F.col("n_estimated") == F.col("_whole")).alias("union_equals_year"))


# Faults that the quarantine query writes into the lines of its case file, by case id.
_FAULTS = {"number": 97, "fields": 101, "time": 103}
_TEXT = "'Case \"' || CAST(case_id AS VARCHAR) || '\", ' || chr(10) || issue_category"
_FAULTY = CASES + f""",
fl AS (SELECT *, {_TEXT} AS body, CASE WHEN case_id % {_FAULTS['number']} = 0 OR case_id % {_FAULTS['fields']} = 0 THEN 'malformed'
  WHEN case_id % {_FAULTS['time']} = 0 THEN 'bad_timestamp' ELSE 'good' END AS problem FROM cases)"""


@register("case_quarantine", ops="A1,B2",
          sql=with_(_FAULTY, """SELECT problem, count(*) AS n, count(sentiment) FILTER (WHERE problem = 'good') AS n_sentiment,
  CAST(coalesce(sum(escalation_level) FILTER (WHERE problem = 'good'), 0) AS BIGINT) AS levels,
  CAST(coalesce(sum(length(body)) FILTER (WHERE problem = 'good'), 0) AS BIGINT) AS n_chars,
  strftime(max(ts) FILTER (WHERE problem = 'good'), '%Y-%m-%d %H:%M:%S') AS last_ts FROM fl GROUP BY problem"""))
def q_case_quarantine(spark, sf_dir):
    """Every case as a CSV line, some broken; read back, broken ones kept apart, both counted."""
    place = workplace(spark, "quarantine")
    k = F.col("case_id")
    hit = lambda name: k % _FAULTS[name] == 0
    text = F.concat(F.lit('Case "'), k.cast("string"), F.lit('", \n'), F.col("issue_category"))
    # an escalation level that is no number, a line that ends early, a time that is none
    fields = {
        "customer_id": F.col("customer_id").cast("string"),
        "timestamp": F.when(hit("time"), "2024-13-45 99:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        "email_body_text": text, "customer_type": F.col("customer_type"), "tenure_type": F.col("tenure_type"),
        "meter_type": F.col("meter_type"), "region": F.col("region"), "issue_category": F.col("issue_category"),
        "sentiment": F.col("sentiment"), "emotion_intensity": F.col("emotion_intensity").cast("string"),
        "escalation_level": F.when(hit("number"), "high").otherwise(F.col("escalation_level").cast("string")),
        "resolution_time": F.col("resolution_time").cast("string"), "manual_annotation": F.lit(None).cast("string")}
    cols = [c.alias(n) for n, c in fields.items()]
    line = F.when(hit("fields"), F.to_csv(F.struct(*cols[:4]), {"escape": '"'})).otherwise(F.to_csv(F.struct(*cols), {"escape": '"'}))
    cases(spark, sf_dir).select(line.alias("value")).write.text(f"{place}/lines")
    lines = TB.read_case_lines(spark, f"{place}/lines", header=False)
    good, bad = TB.quarantine(lines, f"{place}/good", f"{place}/bad")
    zero = F.lit(0).cast("long")
    g = good.agg(F.lit("good").alias("problem"), F.count(F.lit(1)).alias("n"), F.count("sentiment").alias("n_sentiment"),
                 F.sum("escalation_level").alias("levels"), F.sum(F.length("email_body_text")).alias("n_chars"),
                 F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("last_ts")).where("n > 0")
    b = bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), zero.alias("n_sentiment"), zero.alias("levels"),
                                   zero.alias("n_chars"), F.lit(None).cast("string").alias("last_ts"))
    return g.unionByName(b)


@register("silhouette_euclidean", ops="K11,J4", doubles=["a", "b", "silhouette"],
          sql=f"""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  ORDER BY md5(CAST(vec_id AS VARCHAR) || ':{C.SEED}'), vec_id LIMIT {C.SILHOUETTE_SAMPLE}),
sz AS (SELECT label, count(*) AS n FROM e GROUP BY label),
sm AS (SELECT x.vec_id, x.label, y.label AS other, sum(list_distance(x.v, y.v)) AS s FROM e x, e y GROUP BY ALL),
ab AS (SELECT sm.vec_id, sm.label, max(CASE WHEN other = sm.label THEN n END) AS n,
  max(CASE WHEN other = sm.label THEN s / greatest(n - 1, 1) END) AS a, min(CASE WHEN other <> sm.label THEN s / n END) AS b
  FROM sm JOIN sz ON sz.label = other GROUP BY ALL),
si AS (SELECT *, CASE WHEN b IS NULL THEN NULL WHEN n = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS sil FROM ab)
SELECT CASE WHEN grouping(label) = 1 THEN 'all' ELSE CAST(label AS VARCHAR) END AS cluster, count(*) AS n, avg(a) AS a, avg(b) AS b,
  avg(sil) AS silhouette FROM si GROUP BY ROLLUP (label)""")
def q_silhouette_euclidean(spark, sf_dir):
    """Euclidean silhouette of the labels as clusters, over the seeded sample of the vectors."""
    sample = SP.hashed_sample(TB.read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "vec_id",
                              C.SILHOUETTE_SAMPLE)
    return SIL.silhouette_by_cluster(SIL.silhouette_rows(sample, "vec_id", "label", "embedding"), "label")
