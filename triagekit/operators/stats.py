"""Association tests and effect sizes.

Statistics are aggregates over small per-cell or per-value count tables built
with one grouped pass; only the final distribution tail probability of a
handful of test statistics is evaluated on the driver, through the JVM's
commons-math3 distributions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import curves


# ----------------------------------------------------------------------------- distributions (scalars)

def _jvm_math(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.commons.math3


def chi2_sf(spark: SparkSession, x: float, dof: int) -> float:
    if x is None or dof is None or dof <= 0 or x != x:
        return float("nan")
    # the upper tail itself: 1 - cdf is 0 as soon as the tail is below 1e-16
    return float(_jvm_math(spark).special.Gamma.regularizedGammaQ(dof / 2.0, max(0.0, float(x)) / 2.0))


def norm_sf(spark: SparkSession, z: float) -> float:
    if z is None or z != z:
        return float("nan")
    return float(_jvm_math(spark).distribution.NormalDistribution(0.0, 1.0).cumulativeProbability(-float(z)))


def t_sf(spark: SparkSession, t: float, df: float) -> float:
    if t is None or t != t or df is None or df <= 0:
        return float("nan")
    return float(_jvm_math(spark).distribution.TDistribution(float(df)).cumulativeProbability(-float(t)))


# ----------------------------------------------------------------------------- chi-square family

def long_pairs(df: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """(test, a, b) rows for each (test name, column a, column b); NULL keys dropped."""
    parts = F.explode(F.array(*[F.struct(F.lit(t).alias("test"), F.col(a).cast("string").alias("a"),
                                          F.col(b).cast("string").alias("b")) for t, a, b in pairs])).alias("x")
    return df.select(parts).select("x.test", "x.a", "x.b").filter(F.col("a").isNotNull() & F.col("b").isNotNull())


def chi_square_tables(long: DataFrame, yates: bool = True) -> DataFrame:
    """Pearson chi-square per test over the full r x c table (zeros included).

    2x2 tables get the continuity correction (|O-E| reduced by up to 0.5), as
    the usual library default does. Output: test, n, n_rows, n_cols, dof, chi2.
    """
    cells = long.groupBy("test", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy("test", "a").agg(F.sum("o").alias("ra"))
    cols = cells.groupBy("test", "b").agg(F.sum("o").alias("cb"))
    dims = cells.groupBy("test").agg(F.sum("o").alias("n"), F.countDistinct("a").alias("n_rows"),
                                     F.countDistinct("b").alias("n_cols"))
    # full grid per test: equi-join of the two (category-level) margins on the test key
    grid = rows.join(cols, "test").join(cells, ["test", "a", "b"], "left").fillna(0, subset=["o"])
    g = grid.join(dims, "test")
    # doubles before multiplying: the product of two counts overflows a bigint at scale
    e = F.col("ra").cast("double") * F.col("cb") / F.col("n")
    diff = F.abs(F.col("o") - e)
    is22 = (F.col("n_rows") == 2) & (F.col("n_cols") == 2)
    adj = F.when(is22, F.greatest(diff - 0.5, F.lit(0.0))).otherwise(diff) if yates else diff
    term = adj * adj / e
    out = g.groupBy("test", "n", "n_rows", "n_cols").agg(F.sum(term).alias("chi2"))
    return out.select("test", "n", "n_rows", "n_cols",
                      ((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).alias("dof"), "chi2")


def leakage_tests(df: DataFrame, label: str = "escalated") -> DataFrame:
    """Chi-square of sentiment missingness, sentiment and each categorical vs the target."""
    x = df.withColumn("sentiment_missing", F.col("sentiment").isNull().cast("int"))
    pairs = [("sentiment_missing", label, "sentiment_missing"), ("sentiment", "sentiment", label)]
    pairs += [(c, c, label) for c in C.TEST_CAT_COLS]
    return chi_square_tables(long_pairs(x, pairs))


def with_p_values(tests: DataFrame) -> DataFrame:
    """Adds chi-square tail probabilities (one scalar per test, bounded by the test count)."""
    spark = tests.sparkSession
    rows = tests.select("test", "chi2", "dof").collect()
    p = spark.createDataFrame([(r["test"], chi2_sf(spark, r["chi2"], r["dof"])) for r in rows], "test string, p_value double")
    return tests.join(F.broadcast(p), "test")


def cramers_v(df: DataFrame, cols: list[str] = C.CATEGORICAL_COLS) -> DataFrame:
    """Cramér's V for every column pair (i < j), Yates on 2x2, 0 if degenerate."""
    pairs = [(f"{cols[i]}|{cols[j]}", cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    t = chi_square_tables(long_pairs(df, pairs))
    md = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    v = F.when((md == 0) | (F.col("n") == 0), F.lit(0.0)).otherwise(F.sqrt(F.col("chi2") / (F.col("n").cast("double") * md)))
    return t.select(F.split("test", r"\|")[0].alias("feature_1"), F.split("test", r"\|")[1].alias("feature_2"),
                    v.alias("cramers_v"))


def cramers_matrix(cv: DataFrame, cols: list[str] = C.CATEGORICAL_COLS) -> DataFrame:
    """Symmetric matrix in long form: pairs, mirrored pairs and a unit diagonal."""
    spark = cv.sparkSession
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "feature_1 string, feature_2 string, cramers_v double")
    mirror = cv.select(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "cramers_v")
    return cv.unionByName(mirror).unionByName(diag)


# ----------------------------------------------------------------------------- rank test

def mann_whitney(df: DataFrame, col: str, label: str = "escalated") -> DataFrame:
    """Two-sided Mann-Whitney U of class 0 vs class 1.

    Mid-ranks from a per-distinct-value count table and an ascending bucketed
    prefix sum; tie correction from the same table. Output: n0, n1, u (class 0
    statistic), z (continuity-corrected), tie term.
    """
    x = df.select(F.col(col).cast("double").alias("v"), F.col(label).alias("y")).filter(F.col("v").isNotNull())
    hist = x.groupBy("v").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("y") == 0).alias("c0"))
    cum = curves.cumulative(hist, [], "v", ["c"], descending=False)
    mid = (F.col("cum_c") - F.col("c")) + (F.col("c") + 1) / 2.0
    cd = F.col("c").cast("double")
    s = cum.agg(F.sum(F.col("c0") * mid).alias("r0"), F.sum("c0").alias("n0"), F.sum("c").alias("n"),
                F.sum(cd * cd * cd - cd).alias("tie"))
    counts = F.col("n0").alias("n0"), (F.col("n") - F.col("n0")).alias("n1")
    n0, n, n1 = (x.cast("double") for x in (F.col("n0"), F.col("n"), F.col("n") - F.col("n0")))
    u0 = F.col("r0") - n0 * (n0 + 1) / 2.0
    mu = n0 * n1 / 2.0
    sigma = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.col("tie") / (n * (n - 1))))
    u_big = F.greatest(u0, n0 * n1 - u0)
    return s.select(*counts, u0.alias("u"), ((u_big - mu - 0.5) / sigma).alias("z"),
                    F.col("tie").alias("tie_term"))


def mann_whitney_p(mw: DataFrame) -> DataFrame:
    spark = mw.sparkSession
    r = mw.first()
    p = min(1.0, 2.0 * norm_sf(spark, r["z"])) if r["z"] is not None else float("nan")
    return mw.withColumn("p_value", F.lit(p))


# ----------------------------------------------------------------------------- paired t

def paired_t(a: DataFrame, b: DataFrame, key: str = "fold", metric: str = "f2") -> DataFrame:
    """Paired t statistic of metric(a) - metric(b) matched on ``key``."""
    j = a.select(key, F.col(metric).alias("ma")).join(b.select(key, F.col(metric).alias("mb")), key)
    d = j.select((F.col("ma") - F.col("mb")).alias("d"))
    s = d.agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("sd"))
    return s.select("n", "mean_diff", "sd", (F.col("mean_diff") / (F.col("sd") / F.sqrt("n"))).alias("t"))


def paired_t_p(pt: DataFrame) -> DataFrame:
    spark = pt.sparkSession
    r = pt.first()
    t = r["t"]
    p = 2.0 * t_sf(spark, abs(t), r["n"] - 1) if t is not None and t == t else float("nan")
    return pt.withColumn("p_value", F.lit(p))


# ----------------------------------------------------------------------------- correlation / VIF

def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every pair i < j, NULL pairs dropped per pair, in one aggregate."""
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    a = df.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x}|{y}") for x, y in pairs])
    long = a.unpivot([], [f"{x}|{y}" for x, y in pairs], "pair", "r")
    return long.select(F.split("pair", r"\|")[0].alias("col_a"), F.split("pair", r"\|")[1].alias("col_b"), "r")


def max_correlation(corr: DataFrame) -> DataFrame:
    """Strongest |r| pair (first pair by name on ties) and verdict at 0.3 / 0.7 (E5)."""
    first = F.struct(-F.abs("r"), "col_a", "col_b")
    m = corr.agg(F.min_by(F.struct("col_a", "col_b", "r"), first).alias("m"))
    m = m.select("m.col_a", "m.col_b", F.abs("m.r").alias("max_abs_r"))
    verdict = (F.when(F.col("max_abs_r") < C.CORR_LOW, "none").when(F.col("max_abs_r") < C.CORR_HIGH, "moderate")
               .otherwise("high"))
    return m.withColumn("verdict", verdict)


def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """VIF and R^2 of each column regressed on the others.

    The k x k correlation matrix comes from one distributed aggregate; its
    inverse diagonal is VIF (k is the number of columns, not rows).
    """
    c = correlations(df, cols).collect()
    k = len(cols)
    R = np.eye(k)
    pos = {n: i for i, n in enumerate(cols)}
    for r in c:
        i, j = pos[r["col_a"]], pos[r["col_b"]]
        R[i, j] = R[j, i] = r["r"]
    inv = np.linalg.pinv(R)
    spark = df.sparkSession
    rows = []
    for i, n in enumerate(cols):
        v = float(inv[i, i])
        r2 = 1.0 - 1.0 / v if v != 0 else 0.0
        rows.append((n, v, r2))
    out = spark.createDataFrame(rows, "feature string, vif double, r_squared double")
    return out.withColumn("verdict", F.when(F.col("vif") < C.VIF_WARN, "ok").when(F.col("vif") < C.VIF_HIGH, "moderate")
                          .otherwise("high"))
