"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch handed to a Python task; bounds worker memory on long texts.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Hand Python tasks small Arrow batches, so that worker memory follows one batch of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def give_back() -> None:
    """Return what a task has freed to the system; workers are reused and would keep it for the stages that follow."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_rows(df: DataFrame, fn: Callable[..., dict], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``fn(columns of one batch) -> {column: values}`` over Arrow batches, inside the tasks; ``done()`` ends a task."""
    bound_batches(df.sparkSession)
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(*batch.columns)
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, out[f.name]) for f in target)],
                schema=target)
        if done is not None:
            done()
        out = None
        give_back()

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


@lru_cache(maxsize=4)
def rank_encoding(path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """Byte-pair encoding of a rank file, built once per Python worker."""
    import base64

    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


# --- word hashes ---------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown per worker, shared by all texts."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


_INVERSE = pow(int(_BASE), -1, 1 << 64)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    word = np.empty(len(data) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(_SPACE[data], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(text: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text with their byte starts and ends.

    A word's hash is a polynomial over random byte codes modulo 2**64 (prefix
    sums, then finalised), so that one pass of vector operations does a text.
    """
    data = np.frombuffer(text, np.uint8)
    start, end = word_bounds(data)
    if not len(start):
        return np.empty(0, np.uint64), start, end
    if lower:
        data = _LOWER[data]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * powers(int(_BASE), len(data)), dtype=np.uint64, out=total[1:])
    value = (total[end] - total[start]) * powers(_INVERSE, len(data))[start]
    return mix64(value + (end - start).astype(np.uint64)), start, end


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of ``n`` consecutive words (empty with fewer words)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    base = 0xC2B2AE3D27D4EB4F
    total = np.empty(len(words) + 1, np.uint64)
    total[0] = 0
    np.cumsum(words * powers(base, len(words)), dtype=np.uint64, out=total[1:])
    return mix64((total[n:] - total[:m]) * powers(pow(base, -1, 1 << 64), len(words))[:m])


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- components ----------------------------------------------------------------------------

def shared(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (survives lost executors)."""
    from ..session import cut_lineage
    return cut_lineage(df if parts is None else df.coalesce(parts))


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared checkpoint folder, and the table's path for ``remove``."""
    from uuid import uuid4

    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that have no reader left, and let Spark drop shuffle files that nothing refers to."""
    import gc
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    jvm.System.gc()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected links.

    ``edges``: columns ``a``, ``b`` (long; nulls, loops and repeats are dropped).
    Returns ``node``, ``component`` (smallest node reachable) for every node
    that has a link. Alternating large-star and small-star steps, each round
    written to the checkpoint folder; the number of rounds grows with the log of
    the longest chain. A node's neighbours are only aggregated (min), never
    gathered, so a hub costs partial aggregates.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        joined = both.join(lowest, "u")
        if large:   # each larger neighbour goes to the smallest of the neighbourhood
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:       # the node and its smaller neighbours go to the smallest
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    e = shared(edges.where("a is not null and b is not null and a <> b")
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        # done when every node has one link and no target has a link of its own
        ends = e.select(F.col("a").alias("u"), F.lit(1).alias("out"), F.lit(0).alias("to")).unionByName(
            e.select(F.col("b").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("to")))
        left = (ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("to").alias("to"))
                .where("out > 1 or (out > 0 and to > 0)"))
        if left.isEmpty():
            break
        e = shared(stars(stars(e, True), False))
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Bits of the pre-filter below, whatever the number of keys.
FILTER_BITS = 1 << 23


def may_hold(keys: DataFrame, key: str) -> Callable[[F.Column], F.Column]:
    """A test that is true for every key of ``keys`` and for few others: one Bloom filter of fixed size.

    It thins out rows before a join on the key that decides; with many more keys
    than bits it lets everything through, and the join still decides. ``keys``
    should be a written table.
    """
    def places(c: F.Column) -> list[F.Column]:
        return [F.pmod(F.xxhash64(c, F.lit(i)), F.lit(FILTER_BITS)) for i in (101, 102)]

    at = keys.select(F.explode(F.array(*places(F.col(key)))).alias("at"))
    found = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b"))
    every = keys.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "w").join(found, "w", "left")
    # one row with one array of fixed size, a scalar subquery of whatever it filters
    row = every.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("x"))
    bits = row.select(F.transform("x", lambda x: x["b"]).alias("bits")).scalar()

    def test(c: F.Column) -> F.Column:
        out = F.lit(True)
        for at in places(c):
            out = out & (F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out

    return test
