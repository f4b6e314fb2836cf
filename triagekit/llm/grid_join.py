"""Near-duplicate embeddings by an epsilon grid order join.

Cosine >= s between unit vectors is Euclidean distance <= eps = sqrt(2 - 2s).
Vectors are turned to their principal axes (a Spark sum of outer products, one
small eigenproblem on the driver), sorted by the eps-grid cells of the leading
axes, and cut into sequence intervals of equal length. The bounding boxes of the
intervals (at most ``MOST_BLOCKS``) are joined recursively: two stretches of the
sequence whose boxes are farther apart than eps are skipped whole. What remains
is a list of interval pairs, one task each; there the recursion goes on to short
stretches, whose vectors are compared exactly in double precision.

A task returns each vector's number of links and one link to its local
component, never the pairs. Equal vectors are one representative with a
multiplicity. Links go through ``common.components``.

Nulls: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are kept. A row with a null id has a null component, no
links, and is kept. Rows that repeat id and vector are one vector, with a result
row each. Vectors of different dimensions don't link. Only the named columns
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, components, map_rows, shared
from .vectors import matrix, packed, scaled

GRID_AXES = 8        # leading principal axes in the sort order
BLOCK = 2048         # vectors in an interval, unless that made more than MOST_BLOCKS
MOST_BLOCKS = 2000
LEAF = 128           # vectors in the shortest stretch
SLACK = 1e-7         # kept beyond eps when skipping; the comparison itself is exact


def principal_axes(vecs: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes (columns, largest variance first) of the unit vectors of one dimension."""
    def run(v):
        x = scaled(matrix(v, dim)) if len(v) else np.zeros((0, dim))
        return {"n": [len(x)], "total": [x.sum(0).tobytes()], "outer": [(x.T @ x).tobytes()]}

    def add(key, table):
        n = sum(table["n"].to_pylist())
        total, outer = (np.sum([np.frombuffer(b, "<f8") for b in table[c].to_pylist()], axis=0).tobytes()
                        for c in ("total", "outer"))
        return pa.table({"n": [n], "total": [total], "outer": [outer]}, schema=target)

    schema = "n long, total binary, outer binary"
    target = _arrow_schema(vecs.sparkSession, schema)
    parts = map_rows(vecs.select("v"), run, schema)
    # sums of sums: what reaches the driver is at most 16 small matrices
    rows = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(16))).applyInArrow(add, schema).collect()
    n = max(1, sum(r.n for r in rows))
    mean = sum((np.frombuffer(r.total, "<f8") for r in rows), np.zeros(dim)) / n
    outer = sum((np.frombuffer(r.outer, "<f8") for r in rows), np.zeros(dim * dim)).reshape(dim, dim) / n
    _, vectors = np.linalg.eigh(outer - np.outer(mean, mean))
    return mean, np.ascontiguousarray(vectors[:, ::-1])


def distant(lo_a, hi_a, lo_b, hi_b, eps: float) -> bool:
    """True if two boxes are provably farther apart than eps."""
    gap = np.maximum(0.0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float(gap @ gap) > (eps + SLACK) ** 2


def interval_pairs(lo: np.ndarray, hi: np.ndarray, eps: float) -> list[tuple[int, int]]:
    """Pairs (a <= b) of consecutive boxes that may hold vectors within eps, by recursion over the sequence."""
    cache: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(a: int, b: int):
        if (a, b) not in cache:
            cache[a, b] = (lo[a:b].min(0), hi[a:b].max(0))
        return cache[a, b]

    out, todo = [], [((0, len(lo)), (0, len(lo)))] if len(lo) else []
    while todo:
        (a, b), (c, d) = todo.pop()
        if (a, b) != (c, d) and distant(*box(a, b), *box(c, d), eps):
            continue
        if b - a == 1 and d - c == 1:
            out.append((a, c))
            continue
        left = [(a, b)] if b - a == 1 else [(a, (a + b) // 2), ((a + b) // 2, b)]
        right = [(c, d)] if d - c == 1 else [(c, (c + d) // 2), ((c + d) // 2, d)]
        todo += [(s, t) for s in left for t in right if s <= t]
    return out


def stretch_links(x: np.ndarray, y: np.ndarray, same: bool, split: int, least: float, eps: float):
    """(i, j) of linked rows of two intervals laid end to end (the second begins at ``split``).

    x: unit vectors; y: their leading coordinates. With ``same`` there is one
    interval. Each pair comes once.
    """
    cuts = list(range(0, split, LEAF)) + list(range(split, len(x), LEAF)) + [len(x)]
    bounds = list(zip(cuts[:-1], cuts[1:]))
    lo, hi = np.array([y[a:b].min(0) for a, b in bounds]), np.array([y[a:b].max(0) for a, b in bounds])
    first = sum(a < split for a, _ in bounds)
    if same:
        pairs = interval_pairs(lo, hi, eps)
    else:
        pairs = [(a, b) for a, b in interval_pairs(lo, hi, eps) if a < first <= b]
    left, right = [], []
    for a, b in pairs:
        (s, e), (t, u) = bounds[a], bounds[b]
        i, j = np.nonzero(x[s:e] @ x[t:u].T >= least - SLACK)
        i, j = i + s, j + t
        if a == b:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", x[i], x[j]) >= least
        left.append(i[exact])
        right.append(j[exact])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of ``n`` rows over the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, root, new)   # a root follows its members
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(vecs: DataFrame, dim: int, least: float) -> DataFrame:
    """``a, b, n``: b = a: n counts links of a; else a link of a to b. vecs: rep, v, many (distinct vectors)."""
    spark = vecs.sparkSession
    mean, turn = principal_axes(vecs, dim)
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)))
    n_axes = min(GRID_AXES, dim)
    sent = spark.sparkContext.broadcast((mean, turn))

    def place(rep, v, many):
        m, t = sent.value
        y = (scaled(matrix(v, dim)) - m) @ t[:, :n_axes] if len(v) else np.zeros((0, n_axes))
        cell = np.floor(y / max(eps, 1e-9)).astype(np.int32)
        return {"rep": rep, "v": v, "many": many, "cell": cell.tolist()}

    placed = map_rows(vecs.select("rep", "v", "many"), place, "rep long, v binary, many long, cell array<int>")
    # the sequence: sorted by cells, then numbered by what each partition holds
    seq = shared(placed.repartitionByRange("cell", "rep").sortWithinPartitions("cell", "rep")
                 .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).cast("int")
    sizes = sorted((r.p, r.n) for r in seq.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    total, before = 0, []
    for p, n in sizes:
        before.append((p, total))
        total += n
    block = max(BLOCK, -(-total // MOST_BLOCKS))
    start = spark.createDataFrame(before, "p int, first long")
    seq = (seq.withColumn("p", part).join(F.broadcast(start), "p")
           .withColumn("block", F.floor((F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)) / block).cast("int"))
           .select("rep", "v", "many", "block"))

    def box(key, table):
        m, t = sent.value
        y = (scaled(matrix(table["v"], dim)) - m) @ t
        return pa.table({"block": [key[0].as_py()], "lo": [y.min(0).tobytes()], "hi": [y.max(0).tobytes()]}, schema=box_t)

    box_s = "block int, lo binary, hi binary"
    box_t = _arrow_schema(spark, box_s)
    boxes = sorted(seq.select("block", "v").groupBy("block").applyInArrow(box, box_s).collect(), key=lambda r: r.block)
    lo, hi = (np.array([np.frombuffer(r[c], "<f8") for r in boxes]).reshape(len(boxes), -1) for c in ("lo", "hi"))
    pairs = interval_pairs(lo, hi, eps)
    # at most MOST_BLOCKS squared pairs of integers, however many vectors there are
    goes = spark.createDataFrame([(boxes[b].block, boxes[p].block, boxes[q].block) for p, q in pairs for b in {p, q}] or [],
                                 "block int, p int, q int")
    schema = "a long, b long, n long"
    target = _arrow_schema(spark, schema)

    def join(key, table):
        p, q = key[0].as_py(), key[1].as_py()
        block_of = table["block"].to_numpy()
        order = np.argsort(block_of, kind="stable")
        rep, many = table["rep"].to_numpy()[order], table["many"].to_numpy()[order]
        x = scaled(matrix(table["v"], dim))[order]
        m, t = sent.value
        y = (x - m) @ t
        split = int((block_of == p).sum())
        # the grid order again, which the shuffle has lost
        cell = np.floor(y[:, :n_axes] / max(eps, 1e-9))
        again = np.concatenate([s + np.lexsort(cell[s:e].T[::-1]) for s, e in ((0, split), (split, len(x))) if e > s])
        x, y, rep, many = x[again], y[again], rep[again], many[again]
        i, j = stretch_links(x, y, p == q, split, least, eps)
        n = np.bincount(i, many[j], len(x)) + np.bincount(j, many[i], len(x))
        root = local_components(len(x), i, j)
        has, far = np.flatnonzero(n > 0), np.flatnonzero(root != np.arange(len(x)))
        return pa.table({"a": np.concatenate([rep[has], rep[far]]), "b": np.concatenate([rep[has], rep[root[far]]]),
                         "n": np.concatenate([n[has].astype(np.int64), np.zeros(len(far), np.int64)])}, schema=target)

    return seq.join(F.broadcast(goes), "block").groupBy("p", "q").applyInArrow(join, schema)


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: vectors with cosine >= ``least`` link; a component keeps its
    smallest id."""
    vecs = shared(packed(vectors, id_col, vector_col).withColumn("vec_id", F.col("vec_id").cast("long"))
                  .dropDuplicates(["vec_id", "v"]))
    reps = shared(vecs.groupBy("dim", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")))
    dims = [r.dim for r in reps.select("dim").distinct().collect()]
    links = None
    for dim in dims:
        one = _links(reps.where(F.col("dim") == dim), dim, least)
        links = one if links is None else links.unionByName(one)
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    if links is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.lit(True).alias("kept"))
    links = shared(links)
    counts = links.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    member = vecs.join(reps.select("dim", "v", "rep", "many"), ["dim", "v"]).select("vec_id", "rep", "many")
    # one id may carry several vectors; their links and components then meet in the id
    edges = links.where("a <> b").select("a", "b").unionByName(
        member.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    classes = components(edges)
    per_id = (member.join(counts, "rep", "left")
              .groupBy("vec_id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"))
              .join(classes.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    return (ids.join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
