"""Registered queries against their DuckDB SQL on the smallest fixture (fast relational subset)."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as ENTRY
from scripts.check_oracle import TABLES, digest, norm

FAST = ["signature_folds", "distinct_sketches", "case_quarantine", "silhouette_euclidean",
        "segment_performance", "recall_disparity", "confusion", "pr_auc", "best_threshold", "threshold_sweep",
        "threshold_picks", "tier_distribution", "temporal_stability", "cost_sensitivity", "cost_breakeven",
        "calibration_table", "category_rates", "numeric_describe", "chi_square", "cramers_v", "mann_whitney",
        "histogram", "stratified_folds", "fold_overlap", "knn_vote", "monitor_windows", "monitor_weekly",
        "representative_rows", "distribution_shift", "clean_text", "top_words"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    sdf = ENTRY.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(ENTRY.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(norm(sdf)) == digest(norm(odf))


def test_every_query_registered_with_callable():
    qs = ENTRY.queries()
    sql = ENTRY.oracle_sql()
    assert len(qs) >= 100
    assert set(sql) <= set(qs)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert "f2" in df.columns
