"""Table profiling.

Many per-column summaries are computed in one pass by unpivoting the columns
into (column, value) pairs and grouping once; map-side partial aggregation
keeps the shuffle at (column, value) cardinality. Exact quantiles never
gather a column into one task: values are counted per distinct value and the
requested ranks are located with a bucketed prefix sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import calendar as cal
from ..functions import text as TX
from . import curves

# Python's str.split()/strip() whitespace: ASCII and Unicode separators, \x1c-\x1f, NEL.
WS_CLASS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
# A run of non-whitespace: one str.split() word.
WORD_RUN = r"[^\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def table_profile(df: DataFrame) -> DataFrame:
    """Row count and (column, type) list (A3)."""
    n = df.count()
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), n) for f in df.schema.fields],
                                 "column string, dtype string, n_rows long")


def category_rates(df: DataFrame, cols: list[str], label: str = "escalated") -> DataFrame:
    """Per column and value (NULL kept): n and positive rate."""
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [label], cols, "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"),
                                               F.avg(F.col(label).cast("double")).alias("escalation_rate"))


def segment_imbalance(df: DataFrame, cols: list[str], label: str = "escalated") -> DataFrame:
    """Per column and non-NULL value: rate, positives, total (D3)."""
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [label], cols, "column", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.avg(F.col(label).cast("double")).alias("rate"),
                                               F.sum(F.col(label).cast("long")).alias("n_pos"),
                                               F.count(F.lit(1)).alias("n_total"))


def exact_quantiles(df: DataFrame, col: str, qs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per key without collecting a group.

    Per-distinct-value counts, an ascending bucketed prefix sum, then each
    target rank (at most 2 per quantile and key) is located by a range match.
    """
    keys = list(keys or [])
    x = df.select(*keys, F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    hist = x.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))
    cum = curves.cumulative(hist, keys, "v", ["c"], descending=False)
    totals = hist.groupBy(*keys).agg(F.sum("c").alias("n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    tg = totals.select(*keys, "n", F.explode(qarr).alias("q"))
    tg = tg.select(*keys, "q", (F.col("q") * (F.col("n") - 1)).alias("pos"))
    tg = tg.select(*keys, "q", "pos", F.floor("pos").cast("long").alias("i_lo"), F.ceil("pos").cast("long").alias("i_hi"))
    idx = tg.select(*keys, "q", "pos", F.explode(F.array(
        F.struct(F.lit("lo").alias("side"), F.col("i_lo").alias("i")),
        F.struct(F.lit("hi").alias("side"), F.col("i_hi").alias("i")))).alias("t")).select(*keys, "q", "pos", "t.side", "t.i")
    # idx has <= 2 * len(qs) rows per key; the match is a range condition on the prefix sum
    cum_s = cum.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "v", "c", "cum_c")
    cond = [F.col(f"_k_{k}") == F.col(k) for k in keys] + [(F.col("cum_c") - F.col("c")) <= F.col("i"),
                                                          F.col("i") < F.col("cum_c")]
    # 2 * len(qs) target rows per key: broadcast only without keys (a proven bound), else AQE decides
    m = (F.broadcast(idx) if not keys else idx).join(cum_s, cond)
    piv = m.groupBy(*keys, "q", "pos").agg(F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("v_lo"),
                                           F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("v_hi"))
    frac = F.col("pos") - F.floor("pos")
    return piv.select(*keys, "q", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("value"))


def numeric_describe(df: DataFrame, cols: list[str], keys: list[str] | None = None,
                     approx: bool = False) -> DataFrame:
    """count, mean, std (n-1), min, 25%, 50%, 75%, max per column (and key).

    ``approx=True`` uses ``percentile_approx`` (one pass, bounded memory) instead
    of exact ranks.
    """
    keys = list(keys or [])
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        keys, cols, "column", "v").filter(F.col("v").isNotNull())
    base = long.groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    if approx:
        qv = long.groupBy(*keys, "column").agg(F.percentile_approx("v", [0.25, 0.5, 0.75], 10000).alias("p"))
        qv = qv.select(*keys, "column", F.col("p")[0].alias("p25"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p75"))
    else:
        q = exact_quantiles(long, "v", [0.25, 0.5, 0.75], keys + ["column"])
        qv = q.groupBy(*keys, "column").agg(
            F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("p25"),
            F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
            F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("p75"))
    return base.join(qv, keys + ["column"]).select(*keys, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def text_stats(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: cleaned text, character count, word count."""
    return df.select(id_col, TX.clean_text(text_col).alias("text_clean"), TX.char_len(text_col).alias("n_chars"),
                     F.size(F.regexp_extract_all(F.col(text_col), F.lit(WORD_RUN), 0)).alias("word_count"))


def _text_groups(df: DataFrame, text_col: str):
    """(singletons, repeated groups) of exact texts, shuffling full texts only for repeated hashes.

    Phase 1 counts a 64-bit hash per row; texts whose hash is unique are
    distinct for sure. Phase 2 groups the full text of the remaining rows, so
    hash collisions are resolved exactly.
    """
    x = df.filter(F.col(text_col).isNotNull()).select(text_col, F.xxhash64(text_col).alias("_h"))
    hc = x.groupBy("_h").agg(F.count(F.lit(1)).alias("_hn"))
    singles = hc.filter(F.col("_hn") == 1)
    cand = x.join(hc.filter(F.col("_hn") > 1).select("_h"), "_h", "left_semi")
    groups = cand.groupBy("_h", text_col).agg(F.count(F.lit(1)).alias("n"))
    return singles, groups


def duplicate_texts(df: DataFrame, text_col: str, k: int = 5) -> DataFrame:
    """Most repeated exact texts with their counts: a top-k report."""
    _, groups = _text_groups(df, text_col)
    return groups.filter(F.col("n") > 1).orderBy(F.col("n").desc(), F.col(text_col)).limit(k).select(text_col, "n")


def text_uniqueness(df: DataFrame, text_col: str) -> DataFrame:
    """Total rows, distinct texts, rows in duplicated groups, excess copies."""
    singles, groups = _text_groups(df, text_col)
    u = singles.select(F.lit(1).cast("long").alias("n")).unionByName(groups.select("n"))
    g = u.agg(F.sum("n").alias("n_total"), F.count(F.lit(1)).alias("n_unique"),
              F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_in_duplicate_groups"),
              F.count_if(F.col("n") > 1).alias("n_duplicated_texts"))
    return g.select("n_total", "n_unique", (F.col("n_total") - F.col("n_unique")).alias("n_excess"),
                    "n_in_duplicate_groups", "n_duplicated_texts")


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over lower-cased whitespace-split words of all rows."""
    w = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD_RUN), 0)).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, text_col: str, k: int = 20) -> DataFrame:
    """Top-k words by count, ties by word."""
    return word_counts(df, text_col).orderBy(F.col("n").desc(), F.col("word")).limit(k)


def vocabulary_size(df: DataFrame, text_col: str) -> DataFrame:
    wc = word_counts(df, text_col)
    return wc.agg(F.count(F.lit(1)).alias("vocabulary_size"), F.sum("n").alias("n_words"))


def rate_by_calendar(df: DataFrame, ts_col: str = "ts", label: str = "escalated") -> DataFrame:
    """Positive rate and n by year, day name and hour, one long table."""
    long = df.select(F.col(label).cast("double").alias("y"),
                     cal.year(ts_col).cast("string").alias("year"), cal.day_name(ts_col).alias("day_name"),
                     cal.hour(ts_col).cast("string").alias("hour")).unpivot(["y"], ["year", "day_name", "hour"],
                                                                           "dimension", "key")
    return long.groupBy("dimension", "key").agg(F.avg("y").alias("escalation_rate"), F.count(F.lit(1)).alias("n"))


def date_range(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """First and last timestamp (D9), as ISO text."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.agg(F.date_format(F.min(ts_col), fmt).alias("min_ts"), F.date_format(F.max(ts_col), fmt).alias("max_ts"),
                  F.count(F.lit(1)).alias("n"))


def missing_profile(df: DataFrame) -> DataFrame:
    """NULL count and % per column, only columns with NULLs."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = a.unpivot(["__n"], cols, "column", "missing_count")
    return long.filter(F.col("missing_count") > 0).select(
        "column", "missing_count", (F.col("missing_count") / F.col("__n") * 100).alias("missing_pct"))


def hidden_missing(df: DataFrame) -> DataFrame:
    """Blank-after-trim count per string column, only those with blanks."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    blank = lambda c: F.regexp_replace(F.col(c), "^" + WS_CLASS + "+|" + WS_CLASS + "+$", "") == ""
    a = df.agg(*[F.count_if(blank(c)).alias(c) for c in cols])
    return a.unpivot([], cols, "column", "n_blank").filter(F.col("n_blank") > 0)


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long-form crosstab of two columns with margins ('total'); NULL keys dropped."""
    x = df.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull())
    cube = x.cube("a", "b").agg(F.count(F.lit(1)).alias("n"), F.grouping("a").alias("ga"), F.grouping("b").alias("gb"))
    return cube.select(F.when(F.col("ga") == 1, "total").otherwise(F.col("a")).alias("row_key"),
                       F.when(F.col("gb") == 1, "total").otherwise(F.col("b")).alias("col_key"), "n")


def missing_by_level(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """NULL rate % of ``col`` by target class and by escalation level."""
    x = df.select(F.col(col).isNull().cast("double").alias("m"), F.col("escalated").cast("string").alias("escalated"),
                  F.col("escalation_level").cast("string").alias("escalation_level"))
    long = x.unpivot(["m"], ["escalated", "escalation_level"], "dimension", "key")
    return long.groupBy("dimension", "key").agg((F.avg("m") * 100).alias("missing_rate_pct"),
                                                F.count(F.lit(1)).alias("n"))


def class_stats(df: DataFrame, cols: list[str], label: str = "escalated") -> DataFrame:
    """Mean and sample std of numeric columns per class."""
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([label], cols, "column", "v")
    return long.groupBy(label, "column").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                             F.count("v").alias("n"))


def target_distribution(df: DataFrame, label: str = "escalated") -> DataFrame:
    """Count and % per class."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per class
    return g.select(label, "n", (F.col("n") / F.sum("n").over(w) * 100).alias("pct"))


def entity_repeats(df: DataFrame, entity: str = "customer_id", cap: int = C.REPEAT_CAP) -> DataFrame:
    """Entities by rows per entity: 1, 2, ..., cap-1 and '>cap-1' (D14)."""
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("k"))
    b = F.when(F.col("k") >= cap, F.lit(f">{cap - 1}")).otherwise(F.col("k").cast("string"))
    return per.groupBy(b.alias("rows_per_entity")).agg(F.count(F.lit(1)).alias("n_entities"))


def mixed_outcomes(df: DataFrame, entity: str = "customer_id", label: str = "escalated") -> DataFrame:
    """Entities with >1 row; of those, mixed, all-negative and all-positive outcomes.

    One grouped pass (min/max of the label) replaces the semi-joins.
    """
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("k"), F.min(label).alias("lo"), F.max(label).alias("hi"))
    multi = per.filter(F.col("k") > 1)
    return multi.agg(F.count(F.lit(1)).alias("n_multi"),
                     F.count_if(F.col("lo") != F.col("hi")).alias("n_mixed"),
                     F.count_if((F.col("lo") == F.col("hi")) & (F.col("hi") == 0)).alias("n_all_negative"),
                     F.count_if((F.col("lo") == F.col("hi")) & (F.col("hi") == 1)).alias("n_all_positive"))


def histogram(df: DataFrame, col: str, bins: int = 30, keys: list[str] | None = None) -> DataFrame:
    """Equal-width histogram over the column's [min, max]; the last bin is closed."""
    keys = list(keys or [])
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    width = (hi - lo) if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width) * bins) + 1, F.lit(bins)).cast("int")
    g = df.filter(F.col(col).isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*keys, "bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width / bins)).alias("bin_lo"), "n")
