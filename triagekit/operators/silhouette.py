"""Euclidean silhouette of a clustered table (K11), by blocks of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # rows of a block; a task holds two blocks
_STRIP = 32  # rows of one block whose differences are held at a time


def _distance_sums(key, left, right):
    """Per row of the left block and cluster of the right block, the sum of distances."""
    if left.empty or right.empty:
        return pd.DataFrame({"_id": left["_id"][:0], "_other": right["_other"][:0], "_sum": np.zeros(0)})
    x, y = np.stack(left["_x"].to_numpy()), np.stack(right["_y"].to_numpy())
    names, codes = np.unique(right["_other"].to_numpy(), return_inverse=True)
    member = np.eye(len(names))[codes]
    sums = [np.sqrt(((x[i:i + _STRIP, None, :] - y[None]) ** 2).sum(axis=2)) @ member for i in range(0, len(x), _STRIP)]
    return pd.DataFrame({"_id": np.repeat(left["_id"].to_numpy(), len(names)), "_other": np.tile(names, len(x)),
                         "_sum": np.concatenate(sums).ravel()})


def silhouette_rows(df: DataFrame, row_id: str, cluster: str, vec: str, block: int = BLOCK) -> DataFrame:
    """Per row: its cluster's mean distance ``a``, the nearest other cluster's ``b``, and (b - a) / max(a, b).

    Rows are dealt to blocks by hash and every block meets every block once;
    a block pair returns one sum per row and cluster, never a pair of rows.
    The work is quadratic, so large tables are sampled first (J4). A row alone
    in its cluster has silhouette 0, as have rows with a = b = 0; with one
    cluster ``b`` and the silhouette are null. Null ids, clusters or vectors
    take no part; ids are distinct and the clusters few.
    """
    rows = df.select(F.col(row_id).alias("_id"), F.col(cluster).alias("_own"),
                     F.transform(vec, lambda v: v.cast("double")).alias("_x")).dropna().persist()
    n = rows.count()
    blocks = max(1, -(-n // block))
    place = F.pmod(F.xxhash64("_id"), F.lit(blocks))
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.select("_id", "_x", place.cast("int").alias("_lb"), others.alias("_rb"))
    right = rows.select(F.col("_own").alias("_other"), F.col("_x").alias("_y"), place.cast("int").alias("_rb"), others.alias("_lb"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _other {rows.schema['_own'].dataType.simpleString()}, _sum double"
    parts = max(1, min(blocks * blocks, 4 * df.sparkSession.sparkContext.defaultParallelism))
    keys = ["_lb", "_rb"]
    sums = (left.repartition(parts, *keys).groupBy(*keys).cogroup(right.repartition(parts, *keys).groupBy(*keys))
            .applyInPandas(_distance_sums, schema).groupBy("_id", "_other").agg(F.sum("_sum").alias("_sum")))
    sizes = rows.groupBy(F.col("_own").alias("_other")).agg(F.count(F.lit(1)).alias("_n"))
    own = F.col("_other") == F.col("_own")
    t = sums.join(sizes, "_other").join(rows.select("_id", "_own"), "_id").groupBy("_id", "_own").agg(
        F.max(F.when(own, F.col("_n"))).alias("_n"),
        F.max(F.when(own, F.col("_sum") / F.greatest(F.col("_n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~own, F.col("_sum") / F.col("_n"))).alias("b"))
    top = F.greatest("a", "b")
    s = (F.when(F.col("b").isNull(), F.lit(None).cast("double")).when((F.col("_n") == 1) | (top == 0), 0.0)
         .otherwise((F.col("b") - F.col("a")) / top))
    return t.select(F.col("_id").alias(row_id), F.col("_own").alias(cluster), "a", "b", s.alias("silhouette"))


def silhouette_by_cluster(rows: DataFrame, cluster: str) -> DataFrame:
    """Rows, mean a, mean b and mean silhouette per cluster, and of all rows under the name ``all``."""
    means = [F.avg(c).alias(c) for c in ("a", "b", "silhouette")]
    name = F.when(F.grouping(cluster) == 1, F.lit("all")).otherwise(F.col(cluster).cast("string"))
    return rows.rollup(cluster).agg(name.alias("_c"), F.count(F.lit(1)).alias("n"), *means).select(
        F.col("_c").alias("cluster"), "n", "a", "b", "silhouette")
