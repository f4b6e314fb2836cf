"""Fixed values the results depend on.

These are stated once, in natural order, because the analyses must use the
same constants as the workflow they re-create (column groups, costs, grids,
verdict cut-offs).
"""

from __future__ import annotations

import numpy as np

# ---------------------------------------------------------------- fixed values
# Column groups of the case table.
CATEGORICAL_COLS = ["customer_type", "tenure_type", "meter_type", "region",
                    "issue_category", "sentiment"]
NUMERIC_COLS = ["emotion_intensity", "hour", "day_of_week", "month"]
TEXT_COL_CLEAN = "email_body_text_clean"
# Columns never used as features (identifiers, target and its sources, leakage).
EXCLUDE_COLS = ["escalation_level", "resolution_time", "manual_annotation",
                "customer_id", "timestamp", "escalated", "email_body_text"]
# Segment columns analysed on the scored table.
SEGMENT_COLS = ["customer_type", "tenure_type", "meter_type", "region",
                "issue_category", "sentiment"]
# Columns profiled as categories in EDA.
PROFILE_CAT_COLS = ["customer_type", "tenure_type", "meter_type", "region",
                    "sentiment", "issue_category"]
# Categorical columns tested against the target.
TEST_CAT_COLS = ["customer_type", "tenure_type", "meter_type", "region", "issue_category"]
# Fairness attributes.
FAIRNESS_ATTRS = ["region", "customer_type"]
EQUALISED_ODDS_ATTRS = ["region", "customer_type", "tenure_type"]

# Target: escalation level at or above this is positive.
POSITIVE_LEVEL = 2
# Imputed label for a missing sentiment.
UNKNOWN = "Unknown"

# Per-case costs in GBP.
COST_FN = 500
COST_FP = 20
COST_TP = 50
COST_TN = 0
# FN costs tested in the sensitivity study.
FN_COST_GRID = [100, 200, 300, 500, 750, 1000, 2000]
# Fallback breakeven search: FN cost from 10 to 490 by 10.
BREAKEVEN_FALLBACK = (10, 500, 10)

# HIGH-risk tier cut-off.
TIER_HIGH = 0.65
# Calibration bin edges (right-closed, lowest edge included).
CALIBRATION_EDGES = [0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 1.0]
# Margin below the mean threshold for "close" misses.
CLOSE_MARGIN = 0.05
# Minimum positives for a segment PR-AUC / a quarter to be reported.
MIN_POS_PR_AUC = 5
MIN_POS_QUARTER = 5
# Stability verdict: F2 std below this and prevalence std (points) below that.
STABLE_F2_STD = 0.05
STABLE_PREV_STD = 3.0
# Verdict marks in distribution comparisons (percentage points).
FN_TP_MARK = 10.0
FP_TN_MARK = 5.0
# Fairness: 80% rule; equalised-odds gap limits.
FOUR_FIFTHS = 0.8
TPR_GAP_LIMIT = 0.10
FPR_GAP_LIMIT = 0.15
# Correlation verdict cut-offs; VIF cut-offs.
CORR_LOW, CORR_HIGH = 0.3, 0.7
VIF_WARN, VIF_HIGH = 5.0, 10.0
# Entity repeat histogram: counts 1..4 kept, above folded into ">4".
REPEAT_CAP = 5
# Monitoring alert bands.
FLAG_RATE_BAND = (0.30, 0.70)
MEAN_PROB_SHIFT = 0.05
HIGH_RATE_FACTOR = 2.0
OBSERVED_RATE_BAND = (0.08, 0.25)
RECALL_FLOOR = 0.40
SEGMENT_FLAG_DEVIATION = 0.20
CALIBRATION_DRIFT = 0.05
OOV_LIMIT = 0.20
TRAINING_BASE_RATE = 0.146
BASE_RATE_CHANGE = 0.05
# Cross-validation.
N_FOLDS = 5
SEED = 42
# TF-IDF defaults.
TFIDF_MAX_FEATURES = 500
TFIDF_MIN_DF = 3
TFIDF_MAX_DF = 0.95
# Permutation importance repeats; local explanation width.
PERMUTATION_REPEATS = 10
TOP_FEATURES = 10
# kNN neighbour counts; regularisation grid (penalty, C); PCA sizes; K-Means sizes.
KNN_KS = [3, 5, 7, 11, 15]
REG_GRID = [("l2", 1.0), ("l2", 0.1), ("l2", 10.0), ("l1", 1.0), ("l1", 0.1), ("none", None)]
PCA_SIZES = [10, 25, 50, 100]
KMEANS_KS = [2, 3, 4, 5, 7, 10]
SILHOUETTE_SAMPLE = 2000
# Boosted-tree grid.
GBT_GRID = {"n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1]}
# -----------------------------------------------------------------------------


def threshold_grid() -> list[float]:
    """Sweep thresholds 0.10, 0.15, ... 0.85 as produced by ``np.arange``.

    The exact doubles matter (e.g. 0.15000000000000002), so the grid is built
    by the same rule rather than typed in.
    """
    return [float(t) for t in np.arange(0.10, 0.90, 0.05)]
