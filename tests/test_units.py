"""Hand-made frames pinning library-default semantics (Yates, right-closed bins, n vs n-1,
NULL groups, threshold ties, PR-AUC trapezoid, unseen categories, Unicode cleaning)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagekit import config as C
from triagekit.functions import metrics as M
from triagekit.functions.text import clean_text
from triagekit.operators import curves, evaluation as E, features as FE, profiling as PF, stats as ST


def test_yates_2x2(spark):
    rows = [("x", "p")] * 10 + [("x", "q")] * 20 + [("y", "p")] * 15 + [("y", "q")] * 8
    df = spark.createDataFrame(rows, "a string, b string")
    long = ST.long_pairs(df, [("t", "a", "b")])
    with_y = ST.chi_square_tables(long, yates=True).first()
    without = ST.chi_square_tables(long, yates=False).first()
    assert with_y["chi2"] == pytest.approx(4.1086, abs=1e-4)
    assert without["chi2"] == pytest.approx(5.3110, abs=1e-4)
    assert with_y["dof"] == 1


def test_pr_auc_trapezoid_and_ties(spark):
    df = spark.createDataFrame([(0, .9), (1, .8), (1, .7), (0, .4), (1, .3)], "escalated int, y_prob double")
    assert curves.pr_auc(df, []).first()["pr_auc"] == pytest.approx(0.461111, abs=1e-6)
    # top score tied across classes: trapezoid from (0, 1)
    tied = spark.createDataFrame([(1, .9), (0, .9), (1, .5), (0, .1)], "escalated int, y_prob double")
    assert curves.pr_auc(tied, []).first()["pr_auc"] == pytest.approx(0.5 * (0.5 + 1) / 2 + 0.5 * (2 / 3 + 0.5) / 2)


def test_best_threshold_prefers_lowest_on_ties(spark):
    # scores 0.8 and 0.6 give the same F2; the lower one must win
    df = spark.createDataFrame([(1, .8), (0, .6), (1, .6), (0, .6), (0, .2)], "escalated int, y_prob double")
    cv = curves.pr_curve(df, []).orderBy("threshold").collect()
    best = curves.best_threshold(df, []).first()["threshold"]
    f2s = {r["threshold"]: r["f2"] for r in cv}
    top = max(f2s.values())
    assert best == min(t for t, v in f2s.items() if v == top)


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.3,), (1.0,), (0.2000001,)], "y_prob double")
    out = {r["y_prob"]: r["b"] for r in df.select("y_prob", M.right_closed_bin_index("y_prob").alias("b")).collect()}
    assert out[0.0] == 0 and out[0.2] == 0 and out[0.2000001] == 1 and out[0.3] == 1 and out[1.0] == 7


def test_std_pair_and_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    d = PF.numeric_describe(df, ["x"]).first()
    assert d["std"] == pytest.approx(3.559026, abs=1e-6)
    assert (d["p25"], d["p50"], d["p75"]) == pytest.approx((1.75, 3.0, 5.25))
    assert df.agg(F.stddev_pop("x")).first()[0] == pytest.approx(3.082207, abs=1e-6)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.integers(0, 50, 997).astype(float)
    keys = rng.integers(0, 3, 997)
    df = spark.createDataFrame([(int(k), float(v)) for k, v in zip(keys, vals)], "k int, v double")
    got = {(r["k"], r["q"]): r["value"] for r in PF.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["k"]).collect()}
    for k in range(3):
        for q in (0.1, 0.5, 0.9):
            assert got[(k, q)] == pytest.approx(np.quantile(vals[keys == k], q))


def test_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1), (None, 0), ("b", 0)], "c string, escalated int")
    rates = {r["value"]: r["n"] for r in PF.category_rates(df, ["c"]).collect()}
    assert rates[None] == 2
    imb = {r["value"] for r in PF.segment_imbalance(df, ["c"]).collect()}
    assert None not in imb


def test_empty_segment_skipped_and_pr_auc_nan(spark):
    rows = [("s0", 0, 0, 0.1)] * 5 + [("s1", 1, 1, 0.9)] * 4 + [("s1", 0, 0, 0.2)] * 3
    df = spark.createDataFrame(rows, "customer_type string, escalated int, y_pred int, y_prob double")
    seg = E.segment_performance(df, ["customer_type"]).collect()
    assert [r["category"] for r in seg] == ["s1"]
    assert seg[0]["pr_auc"] is None


def test_repeat_customers(spark):
    rows = []
    for cust, n, ys in [(1, 1, [0]), (2, 2, [0, 1]), (3, 3, [1, 1, 1]), (4, 6, [0] * 6), (5, 2, [0, 0])]:
        rows += [(cust, y) for y in ys]
    df = spark.createDataFrame(rows, "customer_id int, escalated int")
    rep = {r["rows_per_entity"]: r["n_entities"] for r in PF.entity_repeats(df).collect()}
    assert rep == {"1": 1, "2": 2, "3": 1, ">4": 1}
    m = PF.mixed_outcomes(df).first()
    assert (m["n_multi"], m["n_mixed"], m["n_all_negative"], m["n_all_positive"]) == (4, 1, 2, 1)


def test_unicode_cleaning_and_hidden_missing(spark):
    df = spark.createDataFrame([("Élan déjà vu!",), ("   ",), (None,)], "t string")
    out = [r[0] for r in df.select(clean_text("t")).collect()]
    assert out[0] == "élan déjà vu"
    hm = PF.hidden_missing(df).collect()
    assert hm[0]["n_blank"] == 1


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    oh = FE.OneHotModel.fit(train, ["c"])
    val = spark.createDataFrame([("z",), ("b",)], "c string")
    cols = [e.alias(n) for n, e in oh.columns()]
    got = val.select("c", *cols).collect()
    assert oh.feature_names() == ["c_b", "c_c"]
    assert [got[0]["c_b"], got[0]["c_c"]] == [0.0, 0.0]
    assert [got[1]["c_b"], got[1]["c_c"]] == [1.0, 0.0]


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    sc = FE.ScalerModel.fit(df, ["x"])
    assert sc.stds["x"] == pytest.approx(3.082207, abs=1e-6)


def test_fbeta_identities(spark):
    df = spark.createDataFrame([(10, 5, 3)], "tp long, fp long, fn long")
    r = df.select(M.f2().alias("f2"), M.f_beta(beta=1.0).alias("f1")).first()
    p, rc = 10 / 15, 10 / 13
    assert r["f2"] == pytest.approx(5 * p * rc / (4 * p + rc))
    assert r["f1"] == pytest.approx(2 * p * rc / (p + rc))
    # dummy all-negative classifier: F2 = 0; zero denominators give 0
    z = spark.createDataFrame([(0, 0, 0)], "tp long, fp long, fn long").select(M.f2()).first()[0]
    assert z == 0.0


def test_threshold_grid_doubles():
    g = C.threshold_grid()
    assert len(g) == 16 and g[1] == 0.15000000000000002 and g[0] == 0.1


def test_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    p = rng.random(500).round(3)
    y = (rng.random(500) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "escalated int, y_prob double")
    got = {round(r["threshold"], 6): r for r in curves.threshold_sweep(df).collect()}
    for t in C.threshold_grid():
        pred = p >= t
        tp = int(((y == 1) & pred).sum())
        fp = int(((y == 0) & pred).sum())
        r = got[round(t, 6)]
        assert (r["tp"], r["fp"]) == (tp, fp)
        assert r["cost"] == tp * 50 + fp * 20 + int(((y == 1) & ~pred).sum()) * 500


def test_cumulative_two_level_matches_pandas(spark):
    rng = np.random.default_rng(11)
    s = np.unique(rng.random(3000).round(5))
    n = rng.integers(1, 5, len(s))
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, n)], "s double, n long")
    got = {r["s"]: r["cum_n"] for r in curves.cumulative(df, [], "s", ["n"]).collect()}
    order = np.argsort(-s)
    cum = np.cumsum(n[order])
    for i, idx in enumerate(order):
        assert got[float(s[idx])] == cum[i]


def test_mann_whitney_against_formula(spark):
    a = [1.0, 2.0, 2.0, 5.0, 7.0]
    b = [2.0, 3.0, 8.0, 9.0]
    df = spark.createDataFrame([(v, 0) for v in a] + [(v, 1) for v in b], "x double, escalated int")
    r = ST.mann_whitney(df, "x").first()
    u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
    assert r["u"] == pytest.approx(u)
    assert math.isfinite(r["z"])


def test_tail_probabilities(spark):
    assert ST.chi2_sf(spark, 3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert ST.chi2_sf(spark, 5.991465, 2) == pytest.approx(0.05, abs=1e-6)
    assert ST.norm_sf(spark, 1.959964) == pytest.approx(0.025, abs=1e-6)
    assert ST.t_sf(spark, 2.776445, 4) == pytest.approx(0.025, abs=1e-6)


def test_f2_evaluator(spark):
    from triagekit.operators.models import F2Evaluator
    df = spark.createDataFrame([(0, .9), (1, .8), (1, .7), (0, .4), (1, .3)], "escalated int, y_prob double")
    f2_fixed = F2Evaluator(threshold=0.7).evaluate(df)
    assert f2_fixed == pytest.approx(5 * 2 / (5 * 2 + 4 * 1 + 1))
    assert F2Evaluator().evaluate(df) >= f2_fixed


def test_lr_penalised_intercept_matches_newton(spark):
    from pyspark.ml.functions import array_to_vector
    from triagekit.operators import models as MD
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 3))
    y = (X @ np.array([1.0, -2.0, 0.5]) + 0.7 + rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(X, y)], "a array<double>, escalated int")
    df = MD.balanced_weights(df.select(array_to_vector("a").alias("features"), "escalated"))
    C = 0.5
    m = MD.ModelSpec("lr", "lr", {"penalty": "l2", "C": C}, "balanced").fit(df, float(len(y)))
    sw = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    ys = np.where(y == 1, 1.0, -1.0)
    Xa = np.hstack([X, np.ones((len(X), 1))])
    beta = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(ys * (Xa @ beta)))
        g = beta - C * (Xa.T @ (sw * ys * p))
        H = np.eye(4) + C * (Xa.T * (sw * p * (1 - p))) @ Xa
        beta -= np.linalg.solve(H, g)
    assert np.allclose(m.coefficients.toArray(), beta[:3], atol=1e-3)
    assert m.intercept == pytest.approx(beta[3], abs=1e-3)


def test_tfidf_vocabulary_and_weights_small_corpus(spark):
    import collections
    docs = ["Café bill bill late", "bill late again", "café meter broken", "late bill", "meter bill café"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    spec = FE.TfidfSpec(max_features=4, ngram_max=2, min_df=2, max_df=0.95)
    vocab = FE.tfidf_vocabulary(df, "text", spec, "doc_id")
    got = {r["term"]: (r["df"], r["tf"], r["idf"]) for r in vocab.collect()}
    toks = [t.lower().replace("é", "e").split() for t in docs]
    grams = [t + [f"{a} {b}" for a, b in zip(t, t[1:])] for t in toks]
    dfc = collections.Counter(g for doc in grams for g in set(doc))
    tfc = collections.Counter(g for doc in grams for g in doc)
    kept = [g for g in dfc if 2 <= dfc[g] <= 0.95 * len(docs)]
    top = sorted(kept, key=lambda g: (-tfc[g], g))[:4]
    assert sorted(got) == sorted(top)
    for g in top:
        assert got[g][:2] == (dfc[g], tfc[g])
        assert got[g][2] == pytest.approx(math.log((1 + len(docs)) / (1 + dfc[g])) + 1)
    w = FE.tfidf_long(df, "doc_id", "text", vocab, spec)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in norms)


def test_pre_normalized_text_gives_same_vocabulary(spark):
    docs = ["Élan déjà vu", "ÉLAN naïve café", "café déjà élan", "naïve café vu"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    spec = FE.TfidfSpec(max_features=10, min_df=1, max_df=1.0)
    a = {r["term"]: (r["df"], r["tf"]) for r in FE.tfidf_vocabulary(df, "text", spec, "doc_id").collect()}
    n = FE.normalized_text(df, "text", "_n", spec)
    b = {r["term"]: (r["df"], r["tf"]) for r in FE.tfidf_vocabulary(n, "_n", FE.pre_normalized(spec), "doc_id").collect()}
    assert a == b and "elan" in a


def test_tfidf_weights_cost_grows_with_the_vocabulary_not_its_square(spark):
    """The L2 norm of a row is taken once, not once for each of its terms."""
    words = [f"w{i:04d}" for i in range(1500)]
    model = FE.TfidfModel(FE.pre_normalized(FE.TfidfSpec(ngram_max=1)), words, [1.0 + i / 1500 for i in range(1500)])
    texts = [" ".join(words[i:i + 30] + words[i:i + 5]) for i in range(0, 1400, 7)] + ["none of them"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    weighted = model.transform(df, "text", "v").select("doc_id", "v")
    assert "aggregate(" not in weighted._jdf.queryExecution().analyzed().toString()     # it stood inside the terms' lambda
    rows = {r["doc_id"]: r["v"].toArray() for r in weighted.collect()}
    want = np.zeros(1500)
    want[:30] = [(1 + math.log(2) * (i < 5)) * model.idf[i] for i in range(30)]
    assert np.allclose(rows[0], want / np.linalg.norm(want), rtol=1e-12)
    assert not rows[len(texts) - 1].any()
