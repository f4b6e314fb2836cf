"""Mergeable distinct counts (D6): one HyperLogLog sketch per key, stored, united and read later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # 4,096 registers, a few KB a sketch


def error_bound(lg_k: int = LG_K) -> float:
    """Three standard deviations of the relative error of a united sketch (1.04 / sqrt(registers) each)."""
    return 3 * 1.04 / (1 << lg_k) ** 0.5


def distinct_sketches(df: DataFrame, keys: list[str], col: str, lg_k: int = LG_K) -> DataFrame:
    """One row per key with the sketch of the column's values (map-side partial sketches; nulls are no value)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(col).cast("string"), F.lit(lg_k)).alias("sketch"))


def united(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser keys from stored ones, without the rows behind them."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, out: str = "n_estimated") -> DataFrame:
    """The sketches' counts. A sketch is united with itself first: its estimate then depends on the registers alone,
    not on the order in which rows or sketches met, so a recomputed task and any way of uniting give the same count."""
    return sketches.withColumn(out, F.hll_sketch_estimate(F.hll_union("sketch", "sketch"))).drop("sketch")
