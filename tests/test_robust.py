"""Staged margins, Euclidean silhouette, distinct sketches, broken input lines, signature folds: against direct computation."""
import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from triagekit.operators import models as MD
from triagekit.operators import silhouette as SIL
from triagekit.operators import sketches as SK
from triagekit.operators import splits as SP
from triagekit.operators import surrogate as SU
from triagekit.sources import tables as TB


def test_staged_scores_equal_direct_fits(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(160, 5)), 2)
    y = (x[:, 0] * x[:, 1] + rng.normal(size=160) * 0.3 > 0).astype(int)
    df = spark.createDataFrame([(i, int(t), Vectors.dense(v)) for i, (v, t) in enumerate(zip(x, y))],
                               ["id", "escalated", "features"]).cache()
    df = MD.pos_weight(df)

    def fit(n):
        return MD.ModelSpec("g", "gbt", {"n_estimators": n, "max_depth": 3, "learning_rate": 0.3}, "pos").estimator(1.0).fit(df)

    got = MD.staged_scores(fit(8), df, [2, 5, 8], ["id"]).toPandas()
    assert len(got) == 3 * 160
    for n in (2, 5, 8):
        want = {r.id: (r.rawPrediction[1], r.probability[1]) for r in fit(n).transform(df).collect()}
        for r in got[got.n_estimators == n].itertuples():
            assert r.margin == pytest.approx(want[r.id][0], abs=1e-12)
            assert r.y_prob == pytest.approx(want[r.id][1], abs=1e-12)


def test_staged_scores_refuse_rounds_not_fitted(spark):
    df = MD.pos_weight(spark.createDataFrame([(0, Vectors.dense([0.0])), (1, Vectors.dense([1.0]))] * 8, ["escalated", "features"]))
    m = MD.ModelSpec("g", "gbt", {"n_estimators": 2, "max_depth": 2}, "pos").estimator(1.0).fit(df)
    with pytest.raises(ValueError):
        MD.staged_scores(m, df, [3], ["escalated"])
    assert MD.staged_scores(m, df.limit(0), [1, 2], ["escalated"]).count() == 0


def brute_silhouette(v, lab):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(v)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][lab == c].mean() for c in set(lab) - {lab[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return out


@pytest.mark.parametrize("block", [7, 1000])
def test_silhouette_equals_brute_force(spark, block):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(61, 6))
    v[10:14] = v[10]  # repeated vectors
    lab = rng.integers(0, 3, size=61)
    lab[60] = 9  # alone in its cluster
    rows = [(i, int(c), [float(t) for t in x]) for i, (x, c) in enumerate(zip(v, lab))]
    df = spark.createDataFrame(rows + [(100, None, [0.0] * 6), (101, 1, None)], "id int, c int, v array<double>")
    got = {r.id: r.silhouette for r in SIL.silhouette_rows(df, "id", "c", "v", block).collect()}
    assert sorted(got) == list(range(61))
    assert np.allclose([got[i] for i in range(61)], brute_silhouette(v, lab), atol=1e-9)
    by = {r.cluster: r for r in SIL.silhouette_by_cluster(SIL.silhouette_rows(df, "id", "c", "v", block), "c").collect()}
    assert by["all"].n == 61 and by["9"].silhouette == 0.0
    assert by["all"].silhouette == pytest.approx(np.mean(brute_silhouette(v, lab)))


def test_silhouette_of_one_cluster_and_of_none(spark):
    one = spark.createDataFrame([(1, 0, [0.0]), (2, 0, [1.0])], "id int, c int, v array<double>")
    assert {r.silhouette for r in SIL.silhouette_rows(one, "id", "c", "v").collect()} == {None}
    assert SIL.silhouette_rows(one.limit(0), "id", "c", "v").count() == 0


def test_sketches_unite_without_the_rows(spark):
    df = spark.range(60000).select((F.col("id") % 5).alias("year"), (F.col("id") % 60).alias("month"),
                                   (F.col("id") % 20011).alias("who"))
    months = SK.distinct_sketches(df, ["year", "month"], "who")
    got = {r.year: r.n_estimated for r in SK.estimated(SK.united(months, ["year"])).collect()}
    own = {r.year: r.n_estimated for r in SK.estimated(SK.distinct_sketches(df, ["year"], "who")).collect()}
    exact = {r.year: r.n for r in df.groupBy("year").agg(F.countDistinct("who").alias("n")).collect()}
    assert got == own
    assert all(abs(got[y] - exact[y]) <= SK.error_bound() * exact[y] for y in exact)
    nulls = SK.estimated(SK.distinct_sketches(df.withColumn("who", F.lit(None).cast("long")), ["year"], "who"))
    assert {r.n_estimated for r in nulls.collect()} == {0}


def test_broken_lines_are_kept_apart(spark):
    d = tempfile.mkdtemp(prefix="tk-bad-")
    path = os.path.join(d, "cases.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(TB.RAW_CASE_SCHEMA.fieldNames()) + "\n")
        f.write('C1,2024-03-04 10:15:00,"Two\nlines, ""quoted""",D,N,S,W,M,,0.7,3,12.5,\n')
        f.write("C2,2024-02-30 10:15:00,no such day,D,N,S,W,M,,0.7,3,12.5,\n")
        f.write("C3,2024-03-04 10:15:00,short line\n")
        f.write("C4,2024-03-04 10:15:00,level in words,D,N,S,W,M,,0.7,three,12.5,\n")
        f.write("C5,,no time given,D,N,S,W,M,,0.7,3,12.5,\n")
        f.write("C6,2024-03-04 10:15:00,long line,D,N,S,W,M,,0.7,3,12.5,,more\n")
    good, bad = TB.quarantine(TB.read_case_lines(spark, path), os.path.join(d, "good"), os.path.join(d, "bad"))
    g = {r.customer_id: r for r in good.collect()}
    assert sorted(g) == ["C1", "C5"] and g["C5"].timestamp is None
    assert g["C1"].email_body_text == 'Two\nlines, "quoted"' and str(g["C1"].timestamp) == "2024-03-04 10:15:00"
    assert good.schema == TB.RAW_CASE_SCHEMA
    b = {r.customer_id: (r.problem, r.corrupt_record) for r in bad.collect()}
    assert b["C2"] == ("bad_timestamp", "2024-02-30 10:15:00")
    assert {k: v[0] for k, v in b.items() if k != "C2"} == {"C3": "malformed", "C4": "malformed", "C6": "malformed"}
    assert "short line" in b["C3"][1] and "three" in b["C4"][1]


def test_signature_folds_deal_every_stratum_evenly(spark):
    rng = np.random.default_rng(8)
    rows = [(f"g{g}", int(rng.integers(0, 2))) for g in range(400) for _ in range(int(rng.integers(1, 4)))]
    df = spark.createDataFrame(rows + [(None, 1), (None, 0), ("null-label", None)], "customer_id string, escalated int")
    got = SP.signature_folds(df).toPandas()
    assert len(got) == 402 and got.customer_id.nunique() == 401
    for _, part in got.groupby(["n_pos", "n_neg"]):
        sizes = part.fold.value_counts().reindex(range(5), fill_value=0)
        assert sizes.max() - sizes.min() <= 1
    sizes = got.fold.value_counts()
    assert sizes.max() - sizes.min() <= 1
    again = SP.signature_folds(df.repartition(3)).toPandas()
    assert dict(zip(got.customer_id, got.fold)) == dict(zip(again.customer_id, again.fold))


def test_local_weights_of_a_linear_scorer_are_its_coefficients(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 12)) * np.arange(1, 13)
    x[:, 4] = 3.0  # no spread
    coef = rng.normal(size=12)
    df = spark.createDataFrame([(f"r{i}", Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    names = [f"f{j:02d}" for j in range(12)]

    def linear(t):
        total = sum((vector_to_array("features")[j] * float(c) for j, c in enumerate(coef)), F.lit(0.5))
        return t.withColumn("_y", total)

    scale = SU.spread(df)
    got = SU.local_weights(df.where("id in ('r1', 'r7')"), "id", names, scale, linear, draws=600).toPandas()
    assert got.groupby("id").size().to_dict() == {"r1": 10, "r7": 10}
    for r in got.itertuples():
        j = names.index(r.feature)
        assert r.weight == pytest.approx(coef[j], abs=1e-8)
        assert r.effect == pytest.approx(coef[j] * scale[j], abs=1e-8)
    want = sorted(range(12), key=lambda j: -abs(coef[j] * scale[j]))[:10]
    assert got[got.id == "r1"].sort_values("rank").feature.tolist() == [names[j] for j in want]
    assert SU.local_weights(df.limit(0), "id", names, scale, linear, draws=600).count() == 0
    with pytest.raises(ValueError):
        SU.local_weights(df, "id", names, scale, linear, draws=12)
