"""Property tests: folds are group-disjoint, permutations keep the multiset, SMOTE reaches
parity inside the minority hull, exact kNN equals brute force, streaming equals batch."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from triagekit.operators import splits as SP
from triagekit.sources.cases import cases
from triagekit.sources.tables import read_table
from triagekit.streaming import monitor as MON


def test_group_folds_disjoint_and_balanced(spark):
    c = SP.assign_group_folds(cases(spark, SF_SMALL))
    ov = SP.fold_overlap(c).first()
    assert ov["n_overlapping"] == 0
    sizes = [r["n"] for r in c.groupBy("fold").count().withColumnRenamed("count", "n").collect()]
    assert len(sizes) == 5 and max(sizes) < 1.5 * min(sizes)


def test_stratified_folds_balanced(spark):
    c = cases(spark, SF_SMALL).select("case_id", "escalated")
    f = SP.stratified_folds(c, "case_id")
    per = f.groupBy("escalated", "fold").count().collect()
    for y in (0, 1):
        cnt = [r["count"] for r in per if r["escalated"] == y]
        assert max(cnt) - min(cnt) <= 1


def test_permutation_preserves_multiset(spark):
    c = cases(spark, SF_SMALL).select("case_id", "emotion_intensity")
    p = SP.permute_column(c, "case_id", "emotion_intensity", seed=5)
    a = sorted(r[0] for r in c.select("emotion_intensity").collect())
    b = sorted(r[0] for r in p.select("emotion_intensity").collect())
    assert a == b
    moved = p.join(c.withColumnRenamed("emotion_intensity", "orig"), "case_id").filter(
        F.col("orig") != F.col("emotion_intensity")).count()
    assert moved > 0.5 * c.count()


def _emb(spark):
    return read_table(spark, SF_SMALL, "embeddings")


def test_knn_exact_against_brute_force(spark):
    e = _emb(spark)
    pts = e.select(F.col("vec_id").alias("_nb"), F.col("embedding").alias("vec"))
    q = e.select("vec_id", F.col("embedding").alias("vec"))
    nn = SP.knn(q, pts, 4, "vec_id", "_nb", "vec", exclude_self=True).collect()
    got = {}
    for r in nn:
        got.setdefault(r["vec_id"], []).append((r["rank"], r["_nb"]))
    rows = e.select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    X = np.array([r[1] for r in rows], dtype=np.float64)
    for i in range(0, len(ids), 25):
        d = ((X - X[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        order = np.lexsort((ids, d))[:4]
        assert [b for _, b in sorted(got[ids[i]])] == list(ids[order])


def test_smote_parity_and_hull(spark):
    rng = np.random.default_rng(1)
    maj = [(f"a{i}", 0, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(60)]
    mino = [(f"b{i}", 1, [float(x) for x in rng.normal(3, 0.5, 3)]) for i in range(12)]
    df = spark.createDataFrame(maj + mino, "case_id string, escalated int, vec array<double>")
    out = SP.smote(df, "case_id", "escalated", "vec", k=5)
    counts = {r["escalated"]: r["count"] for r in out.groupBy("escalated").count().collect()}
    assert counts[0] == counts[1] == 60
    m = np.array([v for _, _, v in mino])
    lo, hi = m.min(axis=0) - 1e-9, m.max(axis=0) + 1e-9
    for r in out.filter("synthetic").collect():
        v = np.array(r["vec"])
        assert np.all(v >= lo) and np.all(v <= hi)


def test_streaming_window_monitor_equals_batch(spark):
    ev_batch = MON.batch_events(spark, SF_SMALL)
    base = MON.baseline(ev_batch)
    batch = {r["window_start"]: (r["n"], round(r["flag_rate"], 9)) for r in MON.window_rates(ev_batch, base).collect()}
    src = tempfile.mkdtemp(prefix="tk-ev-")
    read_table(spark, SF_SMALL, "events").write.mode("overwrite").parquet(os.path.join(src, "events"))
    stream = MON.event_stream(spark, os.path.join(src, "events"))
    ck = tempfile.mkdtemp(prefix="tk-ck-")
    q = MON.start_window_monitor(spark, stream, base, "tk_monitor_windows", ck, output_mode="complete")
    q.processAllAvailable()
    q.stop()
    got = {r["window_start"]: (r["n"], round(r["flag_rate"], 9)) for r in spark.sql("SELECT * FROM tk_monitor_windows").collect()}
    assert got == batch


def test_knn_exact_with_hot_bucket(spark):
    rng = np.random.default_rng(9)
    pts = [[float(x) for x in rng.normal(size=4)] for _ in range(200)] + [[0.5, 0.5, 0.5, 0.5]] * 100
    df = spark.createDataFrame([(i, v) for i, v in enumerate(pts)], "id long, vec array<double>")
    nn = SP.knn(df, df.withColumnRenamed("id", "pid"), 3, "id", "pid", "vec", exclude_self=True, block_target=16).collect()
    got = {}
    for r in nn:
        got.setdefault(r["id"], []).append((r["rank"], r["pid"]))
    X = np.array(pts)
    ids = np.arange(len(pts))
    for i in list(range(0, 200, 17)) + [200, 250, 299]:
        d = ((X - X[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert [b for _, b in sorted(got[i])] == list(np.lexsort((ids, d))[:3])


def test_streaming_segment_monitor_equals_batch(spark):
    ev = MON.batch_events(spark, SF_SMALL)
    batch = {(r["week_start"], r["segment"]): (r["n"], round(r["flag_rate"], 9))
             for r in MON.segment_deviation(MON.segment_rates(ev)).collect()}
    sink = tempfile.mkdtemp(prefix="tk-seg-")
    ck = tempfile.mkdtemp(prefix="tk-ck-")
    stream = MON.event_stream(spark, os.path.join(SF_SMALL, "events*.parquet"))
    q = MON.start_segment_monitor(spark, stream, os.path.join(sink, "out"), ck)
    q.processAllAvailable()
    q.stop()
    got = {(r["week_start"], r["segment"]): (r["n"], round(r["flag_rate"], 9))
           for r in spark.read.parquet(os.path.join(sink, "out")).collect()}
    assert got == batch
