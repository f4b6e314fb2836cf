"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns a unit vector by a pseudo-rotation (three rounds of random
signs and a fast Hadamard transform over the dimension padded to a power of
two) and files it under the nearest signed axis. A query probes in each table
the ``probes`` axes nearest to its turned self. A bucket's vectors are dealt to
blocks by their counted number and a bucket's queries likewise, so a bucket that
holds a third of all rows becomes many tasks; each block returns every query's
best few ids by exact cosine (double precision, original vectors), and these are
merged. Queries that found fewer than ``k`` are compared with all rows, in
blocks. Every row is in the index.

Nulls: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null id, take no part. Vectors of different dimensions are not
compared. Repeated rows are indexed once; an id with several vectors counts once
in a result, by its best one. Only the named columns
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, map_rows, shared
from .vectors import matrix, packed, scaled

TABLES = 16
#: With 16 tables, 8 probes find 0.98 of the five nearest of 500 and 0.99 of 2,000 flat 64-dimensional vectors (4: 0.89, 0.94).
PROBES = 8
BLOCK = 8192          # vectors of a bucket in one task
QUERY_BLOCK = 1024    # queries of a bucket in one task
SLACK = 1e-9          # what a matrix product may differ by from the exact score


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Hadamard transform of the rows; their size is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(x), -1)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int, seed: int = 71) -> np.ndarray:
    """Pseudo-rotation of unit rows for one table, padded to a power of two."""
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    rng = np.random.default_rng([seed, table, x.shape[1]])
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], width))
    return x


def axes(turned: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest signed axes of turned rows, nearest first; axis i is 2i, its negative 2i + 1."""
    n = min(n, 2 * turned.shape[1])
    both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    if n == 1:
        return both.argmax(1)[:, None]
    part = np.argpartition(-both, n - 1, axis=1)[:, :n]
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(both, part, 1), axis=1, kind="stable"), 1)


def _best(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int):
    """(query id, id, cosine) of each query's ``k`` best distinct ids by their best rows, ties to the smaller id; never
    its own id."""
    order = np.argsort(ids, kind="stable")
    ids, xs, qs = ids[order], scaled(x[order]), scaled(q)
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))   # where the rows of an id begin
    out: tuple[list, list, list] = ([], [], [])
    for begin in range(0, len(qids), 256):
        score = qs[begin:begin + 256] @ xs.T
        score[qids[begin:begin + 256, None] == ids[None]] = -2.0
        top = score if len(first) == len(ids) else np.maximum.reduceat(score, first, axis=1)
        for i, row in enumerate(score):
            least = np.partition(top[i], -k)[-k] if len(first) > k else -1.5
            at = np.flatnonzero(row >= max(least - SLACK, -1.5))
            exact = np.minimum(1.0, np.maximum(-1.0, np.einsum("ij,j->i", xs[at], qs[begin + i])))
            order = np.lexsort((ids[at], -exact))
            seen: set = set()
            for o in order:
                if ids[at[o]] not in seen:
                    seen.add(ids[at[o]])
                    out[0].append(qids[begin + i])
                    out[1].append(ids[at[o]])
                    out[2].append(exact[o])
                if len(seen) == k:
                    break
    return out


def _blocks(rows: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Best ``k`` of each query within each key's rows, block by block."""
    n = (rows.groupBy(*keys).agg(F.count("*").alias("n"))
         .join(queries.groupBy(*keys).agg(F.count("*").alias("m")), keys)
         .withColumn("bx", F.ceil(F.col("n") / BLOCK).cast("int"))
         .withColumn("bq", F.ceil(F.col("m") / QUERY_BLOCK).cast("int")).select(*keys, "bx", "bq"))
    n = shared(n)   # as many rows as buckets: tables x signed axes

    def spread(side: DataFrame, own: str, other: str, role: int) -> DataFrame:
        at = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int").alias(own[1])
        return (side.join(F.broadcast(n), keys)
                .select(*keys, "vec_id", "v", F.lit(role).alias("role"), at,
                        F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[1])))

    both = spread(rows, "bx", "bq", 0).unionByName(spread(queries, "bq", "bx", 1))
    schema = "query_id long, vec_id long, score double"
    target = _arrow_schema(rows.sparkSession, schema)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        role = table["role"].to_numpy()
        ids, x = table["vec_id"].to_numpy(), matrix(table["v"], dim)
        out = _best(ids[role == 0], x[role == 0], ids[role == 1], x[role == 1], k) if 0 < role.sum() < len(role) \
            else ([], [], [])
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(out, target)], schema=target)

    return both.groupBy(*keys, "x", "q").applyInArrow(run, schema)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row where ``is_query`` holds
    (a condition on the column ``vec_id``)."""
    vecs = shared(packed(vectors, id_col, vector_col).withColumn("vec_id", F.col("vec_id").cast("long"))
                  .dropDuplicates(["vec_id", "v"]))
    wanted = vecs.where(is_query)

    def index(n_probes):
        def run(ids, dim, v):
            dims, raw = dim.to_numpy(), v.to_pylist()
            out = {c: [] for c in ("dim", "t", "axis", "vec_id", "v")}
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = scaled(np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(-1, d))
                own = ids.to_numpy()[at]
                for t in range(tables):
                    near = axes(rotate(x, t), n_probes)
                    for c, y in zip(out, (np.full(near.size, d), np.full(near.size, t), near.ravel(),
                                          np.repeat(own, near.shape[1]))):
                        out[c].append(y)
                    out["v"] += [raw[i] for i in at for _ in range(near.shape[1])]
            ints = {c: pa.array(np.concatenate(out[c]) if out[c] else [], pa.int64() if c == "vec_id" else pa.int32())
                    for c in ("dim", "t", "axis", "vec_id")}
            return ints | {"v": out["v"]}
        return run

    schema = "dim int, t int, axis int, vec_id long, v binary"
    rows, asked = map_rows(vecs, index(1), schema), map_rows(wanted, index(probes), schema)
    found = shared(_merge(_blocks(rows, asked, ["dim", "t", "axis"], k), k))
    # queries short of k results meet all rows of their dimension
    short = wanted.join(found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    short = shared(short)
    if not short.isEmpty():
        rest = _merge(_blocks(vecs, short, ["dim"], k), k)
        found = (found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
                 .unionByName(rest))
    return found


def _merge(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
