"""Splitting, sampling and resampling (J1-J5, H1) and exact nearest neighbours (K6 search).

No split uses an unpartitioned window over rows: positions inside a stratum
come from a bucketed prefix sum (bucket = hash or value range), so a stratum
holding a third of all entities is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import persist_shared
from . import curves
from .metric_index import CellIndex, TreeIndex

HASH_BUCKETS = 1 << 12
# Points beyond which a search tries a tree of boxes.
TREE_ROWS = 20_000
# Rows of a partition of a search.
PART_ROWS = 50_000


def _positions(df: DataFrame, keys: list[str], order_col: str, bucket) -> DataFrame:
    """0-based position of each row within ``keys`` in ``order_col`` order (two-level)."""
    h = df.withColumn("_one", F.lit(1))
    cnt = h.groupBy(*keys, bucket.alias("_pb")).agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.select(*keys, "_pb", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    x = h.withColumn("_pb", bucket).join(off, keys + ["_pb"])
    wi = Window.partitionBy(*keys, "_pb").orderBy(order_col)
    return x.withColumn("_pos", F.col("_off") + F.row_number().over(wi) - 1).drop("_one", "_pb", "_off")


def group_folds(df: DataFrame, group: str = "customer_id", label: str = "escalated",
                n_folds: int = C.N_FOLDS, seed: int = C.SEED, rate_bands: int = 20) -> DataFrame:
    """Group-disjoint, class-balanced folds (J1): one row per group with its fold.

    Groups are ordered by positive-rate band, then by a seeded hash, and dealt
    round-robin over that order, so every fold receives groups from every
    band. Group isolation is exact by construction; positions come from a
    two-level prefix sum (band x hash bucket), never a global window.
    """
    g = df.groupBy(group).agg(F.sum(F.col(label).cast("long")).alias("_npos"), F.count(F.lit(1)).alias("_n"))
    g = g.withColumn("_h", F.xxhash64(F.col(group).cast("string"), F.lit(seed)))
    band = F.least(F.floor(F.col("_npos") / F.col("_n") * rate_bands), F.lit(rate_bands)).cast("long")
    g = g.withColumn("_band", band).withColumn("_one", F.lit(0))
    bucket = F.col("_band") * HASH_BUCKETS + F.pmod(F.col("_h"), F.lit(HASH_BUCKETS))
    p = _positions(g, ["_one"], "_h", bucket)
    return p.select(group, F.pmod(F.col("_pos"), F.lit(n_folds)).cast("int").alias("fold"),
                    F.col("_band").alias("rate_band"), F.col("_pos").alias("position"), F.col("_n").alias("n_rows"))


def assign_group_folds(df: DataFrame, group: str = "customer_id", label: str = "escalated",
                       n_folds: int = C.N_FOLDS, seed: int = C.SEED) -> DataFrame:
    """Rows with the fold of their group (keyed join; AQE splits a hot group's partition)."""
    f = group_folds(df, group, label, n_folds, seed).select(group, "fold")
    return df.drop("fold").join(f, group)


def signature_folds(df: DataFrame, group: str = "customer_id", label: str = "escalated", n_folds: int = C.N_FOLDS,
                    seed: int = C.SEED) -> DataFrame:
    """Group-disjoint folds dealt within each (positives, negatives) signature (J1): one row per group.

    Groups of equal signature are dealt in turn in the order of a seeded md5;
    the turn goes on from stratum to stratum, so folds differ by at most one
    group in every stratum and in all. Places inside a stratum come from a
    bucketed prefix sum; the offsets need one row per distinct signature.
    A null group is one group, null labels count as neither class.
    """
    g = df.groupBy(group).agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"))
    g = g.withColumn("_h", F.md5(F.concat_ws(":", F.col(group).cast("string"), F.lit(str(seed)))))
    sig = ["n_pos", "n_neg"]
    p = _positions(g, sig, "_h", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))  # 4,096 buckets in md5 order
    before = Window.orderBy(*sig).rowsBetween(Window.unboundedPreceding, -1)
    start = g.groupBy(*sig).agg(F.count(F.lit(1)).alias("_n")).select(
        *sig, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return p.join(start, sig).select(group, *sig, F.pmod(F.col("_start") + F.col("_pos"), F.lit(n_folds)).cast("int").alias("fold"))


def hashed_sample(df: DataFrame, row_id: str, n: int, seed: int = C.SEED) -> DataFrame:
    """First ``n`` rows in the order of a seeded md5 of the id (J4), the same in any engine: a sampling operator."""
    h = F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed))))
    return df.withColumn("_u", h).orderBy("_u", row_id).limit(n).drop("_u")


def fold_overlap(df: DataFrame, group: str = "customer_id", fold: str = "fold") -> DataFrame:
    """Groups found in more than one fold (H1); must be zero."""
    g = df.groupBy(group).agg(F.countDistinct(fold).alias("k"))
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("k") > 1).alias("n_overlapping"))


def stratified_folds(df: DataFrame, row_id: str, label: str = "escalated", n_folds: int = C.N_FOLDS) -> DataFrame:
    """Ungrouped stratified folds (J2): k-th row of each class (by row id) goes to fold k mod n.

    Shares groups across folds by design (as the learning-curve study does).
    """
    b = curves.cut_bucket(df, row_id)
    p = _positions(df, [label], row_id, b)
    return p.withColumn("fold", F.pmod(F.col("_pos"), F.lit(n_folds)).cast("int")).drop("_pos")


def seeded_uniform(col: str, seed: int = C.SEED):
    """Deterministic U[0,1) per key (reproducible under recomputation)."""
    return (F.pmod(F.xxhash64(F.col(col).cast("string"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30))


def training_prefix(df: DataFrame, row_id: str, fraction: float, seed: int = C.SEED) -> DataFrame:
    """Nested seeded subset of a training set of about ``fraction`` of its rows (learning-curve sizes)."""
    return df.filter(seeded_uniform(row_id, seed) < F.lit(float(fraction)))


def seeded_sample(df: DataFrame, row_id: str, n: int, seed: int = C.SEED) -> DataFrame:
    """First ``n`` rows in seeded-hash order (J4): a sampling operator."""
    return df.withColumn("_u", F.xxhash64(F.col(row_id).cast("string"), F.lit(seed))).orderBy("_u", row_id).limit(n).drop("_u")


def permute_column(df: DataFrame, row_id: str, col: str, seed: int) -> DataFrame:
    """Seeded permutation of one column across rows.

    Rows are ranked twice, by row id and by a seeded hash; the column value at
    rank r moves to the row holding hash-rank r. Two keyed position tables and
    one equi-join; the multiset of values is preserved.
    """
    b = curves.cut_bucket(df, row_id)
    one = df.withColumn("_k", F.lit(0))
    by_id = _positions(one.select("_k", row_id, col), ["_k"], row_id, b).select(F.col("_pos").alias("_r"), F.col(col).alias("_v"))
    hashed = one.select("_k", row_id, F.xxhash64(F.col(row_id).cast("string"), F.lit(seed)).alias("_h"))
    by_h = _positions(hashed, ["_k"], "_h", F.pmod(F.col("_h"), F.lit(HASH_BUCKETS))).select(row_id, F.col("_pos").alias("_r"))
    perm = by_h.join(by_id, "_r").select(row_id, F.col("_v").alias(col))
    return df.drop(col).join(perm, row_id)


def knn(queries: DataFrame, points: DataFrame, k: int, qid: str, pid: str, vec: str = "vec",
        exclude_self: bool = False, block_target: int = 256) -> DataFrame:
    """Exact k nearest points (squared Euclidean, ties by point id) for every query: ``qid, pid, sq_dist, rank``.

    Large tables are searched by a tree of boxes if it tells near points from far ones, others by cells.
    """
    if points.limit(TREE_ROWS + 1).count() > TREE_ROWS:
        index = TreeIndex(points, pid, vec)
        found = index.search(queries, k, qid, vec, exclude_self) if index.useful else None
        if found is not None:
            return found.neighbours
    return CellIndex(points, pid, vec, block_target).search(queries, k, qid, vec, exclude_self).neighbours


def smote(train: DataFrame, row_id: str, label: str = "escalated", vec: str = "vec", k: int = 5,
          seed: int = C.SEED) -> DataFrame:
    """SMOTE on training rows (J3): synthetic minority rows to class parity.

    Each synthetic row lies on the segment between a minority row and one of
    its k nearest minority neighbours (exact kNN), at a seeded position.
    Minority rows are given near-equal shares of the n_major - n_minor rows.
    """
    counts = train.groupBy(label).count().collect()
    cmap = {r[label]: r["count"] for r in counts}
    if len(cmap) < 2:
        return train.select(row_id, label, vec).withColumn("synthetic", F.lit(False))
    minority = min(cmap, key=lambda c: (cmap[c], c))
    majority = max(cmap, key=lambda c: (cmap[c], -c))
    need = cmap[majority] - cmap[minority]
    if need and cmap[minority] < 2:
        raise ValueError("one minority row has no neighbour to interpolate towards")
    mino = train.filter(F.col(label) == minority).select(row_id, vec)
    # read several times; few bytes a row, much arithmetic: partitions follow cores and rows, not bytes
    parts = max(2 * train.sparkSession.sparkContext.defaultParallelism, -(-cmap[minority] // PART_ROWS))
    mino = persist_shared(mino.repartition(parts) if cmap[minority] > TREE_ROWS else mino)
    nn = knn(mino, mino.withColumnRenamed(row_id, "_nb"), k, row_id, "_nb", vec, exclude_self=True)
    n_min = cmap[minority]
    base, extra = divmod(need, n_min)
    pos = _positions(mino.withColumn("_k", F.lit(0)), ["_k"], row_id,
                     F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(HASH_BUCKETS)))
    reps = pos.select(row_id, vec, (F.lit(base) + (F.col("_pos") < extra).cast("int")).alias("_reps"))
    syn = reps.select(row_id, vec, F.explode(F.sequence(F.lit(1), F.col("_reps"))).alias("_j")).filter(F.col("_reps") > 0)
    u = lambda salt: (F.pmod(F.xxhash64(F.col(row_id).cast("string"), F.col("_j"), F.lit(seed + salt)),
                             F.lit(1 << 30)) / float(1 << 30))
    syn = syn.withColumn("_gap", u(2))
    kk = F.least(F.lit(k), F.lit(max(n_min - 1, 1)))
    syn = syn.withColumn("_pick", (F.floor(u(1) * kk) + 1).cast("int"))
    nbr = nn.select(F.col(row_id).alias("_src"), "_nb", F.col("rank").alias("_r"))
    s = syn.join(nbr, (syn[row_id] == nbr["_src"]) & (syn["_pick"] == nbr["_r"]))
    nv = mino.select(F.col(row_id).alias("_nb"), F.col(vec).alias("_nv"))
    s = s.join(nv, "_nb")
    newv = F.zip_with(F.col(vec), F.col("_nv"), lambda a, b: a + F.col("_gap") * (b - a))
    synth = s.select(F.concat_ws("#", F.col(row_id).cast("string"), F.col("_j").cast("string")).alias(row_id),
                     F.lit(minority).alias(label), newv.alias(vec), F.lit(True).alias("synthetic"))
    orig = train.select(F.col(row_id).cast("string").alias(row_id), label, vec, F.lit(False).alias("synthetic"))
    return orig.unionByName(synth)
