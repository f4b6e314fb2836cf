"""Vocabulary counts, weights and cleaning: equal to the plain forms."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagekit.functions.text import clean_text
from triagekit.operators import features as FE

SMALL = FE.TfidfSpec(max_features=12, min_df=2, max_df=0.9)


def _texts(spark):
    rng = np.random.default_rng(3)
    words = ["Stra\u00dfe", "caf\u00e9", "e\u0301te", "x", "no_1", "\u2167\u00bd", "\u0130zmir", "data", "row", "the", "of", "spark", "task"]
    p = 1.0 / np.arange(1, len(words) + 1)
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30), p=p / p.sum()))) for i in range(80)] + [(80, None), (81, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _plain(df, spec):
    n = df.count()
    rows = FE._term_counts(df, "text", spec).where((F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * n))
    return {(r["term"], r["df"], r["tf"]) for r in rows.orderBy(F.desc("tf"), "term").limit(spec.max_features).collect()}


@pytest.mark.parametrize("guess, most", [(1000, 20_000), (1, 20_000), (1, 0)])
def test_vocabulary_counts_only_pairs_that_can_enter(spark, monkeypatch, guess, most):
    """Whether the first rows lead to the right words, a second pass is needed, or there are too many words to place."""
    monkeypatch.setattr(FE, "GUESS_ROWS", guess)
    monkeypatch.setattr(FE, "MOST_LEADS", most)
    df = _texts(spark)
    for spec in (SMALL, FE.TfidfSpec(max_features=400, min_df=2, max_df=0.9), FE.TfidfSpec(max_features=5, ngram_max=1, min_df=1)):
        found = {(r["term"], r["df"], r["tf"]) for r in FE.tfidf_vocabulary(df, "text", spec).collect()}
        assert found == _plain(df, spec)


def test_vocabulary_explodes_no_tokens(spark):
    """Tokens are counted inside the tasks; the relational form made a row of each of them."""
    plan = FE._counts(_texts(spark), "text", SMALL, ["data", "row"])._jdf.queryExecution().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_weights_follow_the_formula(spark):
    df = _texts(spark)
    vocab = FE.tfidf_vocabulary(df, "text", SMALL)
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    got = {(r["doc_id"], r["term"]): r["weight"] for r in FE.tfidf_long(df, "doc_id", "text", vocab, SMALL).collect()}
    want = {}
    for r in FE.with_terms(df, "text", SMALL, "t").collect():
        terms = [t for t in r["t"] or [] if t in idf]
        w = {t: (1 + np.log(terms.count(t))) * idf[t] for t in terms}
        norm = np.sqrt(sum(v * v for v in w.values()))
        want |= {(r["doc_id"], t): v / norm for t, v in w.items()}
    assert got.keys() == want.keys() and any(" " in t for _, t in got)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_clean_text_joins_gaps(spark):
    rows = [("  A,b ", "a b"), ("x\t\ty", "x y"), ("x \n", "x"), ("...", ""), ("", ""), (None, None), ("a\u00a0- b_1", "a b_1"),
            ("one two", "one two"), ("\nA!!", "a")]
    got = spark.createDataFrame(rows, "t string, want string").select(clean_text("t").alias("t"), "want").collect()
    assert all(r["t"] == r["want"] for r in got)
