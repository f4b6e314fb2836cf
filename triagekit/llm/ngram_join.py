"""N-gram Jaccard join with prefix filters under several global token orders.

A document's tokens are its distinct ``n``-word shingles (64-bit hashes). Under
any global order of the tokens, two sets of similarity >= t share k tokens of
their prefixes, the first ``size - ceil(t size) + k`` tokens. So candidates must
share that many under each order, and pairs are verified only after the filters:

1. Equal sets are one node, so copies are never paired.
2. Tokens that occur often go last in every order. They are found by bounded
   summaries that each task makes of all its documents; the list (at most
   ``COMMON_TOKENS``) shapes the orders, never the results.
3. First order: the prefix tokens meet by token. A node goes on only if enough
   of its prefix tokens are in other nodes' prefixes too. Common tokens need no
   counting, so no frequent key is shuffled for it.
4. The nodes of each token join the cluster of the token's hub, so that two
   candidates are in one cluster. Hub and member pairs pass the size filter, then
   the prefixes of the second order (native array intersection), then exact
   intersection; links make components.
5. A cluster that holds several components is compared in blocks of bounded
   size, a task counting the common tokens of all pairs of two blocks at once.
   Pairs are never rows, and a group of near copies that its hub links needs no
   further proof.

No pair that meets the threshold is left unproven across components.

Nulls: a null text, or one without words, has no shingles and links with
nothing. Rows with a null id link with nothing and have a null component. Rows
that repeat an id are one document; their sets' links meet in it. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (_arrow_schema, as_long, bound_batches, components, map_rows, may_hold, mix64, remove, shared, stored,
                     window_hashes, word_hashes)
from .grid_join import local_components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 3, 4      # threshold 0.75, in whole numbers
ORDERS = (0x1234567, 0x89ABCDE)    # seeds of the token orders; the first one is the index
SHARE = 12                         # one in so many of a set's tokens must be met within the prefixes
COMMON_TOKENS = 200_000
SUMMARY_ROWS = 20_000              # tokens in one task's summary
SUMMARY_LEAST = 4                  # occurrences within a task that make a token worth reporting
SUMMARY_HELD = 4_000_000           # tokens a task holds before it condenses
CLUSTER_BLOCK = 2048               # nodes in a block of a cluster
SHARD_ROWS = 4000                  # rows that a task compares, unless one pair of blocks has more


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of the whole sequence if it has fewer words."""
    if not text:
        return np.empty(0, np.uint64)
    words = word_hashes(text.encode(), lower=True)[0]
    if not len(words):
        return words
    if len(words) < n:
        return mix64(window_hashes(words, len(words)) + np.uint64(len(words)))
    tokens = np.sort(window_hashes(words, n))
    return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]


def needed(size: int) -> int:
    """k: how many tokens the prefixes of two similar sets share, if neither is smaller."""
    return max(1, size // SHARE)


def prefix_size(size: int) -> int:
    return min(size, size - -(-NUMERATOR * size // DENOMINATOR) + needed(size)) if size else 0


def _needed(size: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(size / SHARE))


def _least_needed(size: Column) -> Column:
    """The same for a set and the smallest partner that it can have."""
    return _needed(F.ceil(size * NUMERATOR / DENOMINATOR))


def ordered(tokens: np.ndarray, seed: int, common: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """The tokens of a set with its prefix under one order first, and the size of the prefix.

    Rare tokens go by hash, then common ones by frequency, then hash. common:
    sorted tokens; rank: their place by frequency, rarest first. Tokens that tie
    with the last one are all taken, so ties need no order.
    """
    p = prefix_size(len(tokens))
    key = mix64(tokens ^ np.uint64(seed)) >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        hit = common[at] == tokens
        # common tokens: upper half, by rank, hash breaks ties of equal counts
        key[hit] = np.uint64(1 << 63) | (rank[at[hit]].astype(np.uint64) << np.uint64(32)) | (key[hit] >> np.uint64(31))
    if p >= len(tokens):
        return tokens, len(tokens)
    first = key <= np.partition(key, p - 1)[p - 1]
    return np.concatenate([tokens[first], tokens[~first]]), int(first.sum())


def prefix(tokens: np.ndarray, seed: int, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first tokens of a set under one order."""
    out, p = ordered(tokens, seed, common, rank)
    return out[:p]


def _summaries(docs: DataFrame, n: int) -> DataFrame:
    """One pass over whole texts: ``doc, size, node`` of every document, and ``token, many`` of each task's summary."""
    bound_batches(docs.sparkSession)
    schema = "doc long, size long, node long, token long, many long"
    target = _arrow_schema(docs.sparkSession, schema)

    def condense(held: list[np.ndarray], counts: tuple[np.ndarray, np.ndarray] | None):
        flat = np.sort(np.concatenate([*held, np.empty(0, np.uint64)]))
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, int)
        token, many = flat[first], np.diff(np.append(first, len(flat)))
        if counts is not None:
            token, inverse = np.unique(np.concatenate([token, counts[0]]), return_inverse=True)
            many = np.bincount(inverse, np.concatenate([many, counts[1]]), len(token)).astype(int)
        ok = many >= 2
        return token[ok], many[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held, counts = [], 0, None
        for batch in batches:
            size, node = [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, n)
                size.append(len(s))
                node.append(_node(s) if len(s) else None)
                held.append(s)
                size_held += len(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                                              pa.nulls(len(size), pa.int64()), pa.nulls(len(size), pa.int64())], schema=target)
            if size_held > SUMMARY_HELD:
                counts, held, size_held = condense(held, counts), [], 0
                if len(counts[0]) > SUMMARY_HELD:   # the heavier half stays
                    top = np.argpartition(-counts[1], SUMMARY_HELD // 2)[:SUMMARY_HELD // 2]
                    counts = counts[0][np.sort(top)], counts[1][np.sort(top)]
        token, many = condense(held, counts)
        ok = many >= SUMMARY_LEAST
        token, many = token[ok], many[ok]
        if len(token) > SUMMARY_ROWS:
            top = np.argpartition(-many, SUMMARY_ROWS)[:SUMMARY_ROWS]
            token, many = token[top], many[top]
        none = pa.nulls(len(token), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(as_long(np.ascontiguousarray(token)), pa.int64()),
                                          pa.array(many, pa.int64())], schema=target)

    return docs.select("doc", "text").mapInArrow(run, schema)


def _possible(a: Column, b: Column) -> Column:
    """Size filter: similarity cannot exceed the ratio of the sizes."""
    return (a * DENOMINATOR >= b * NUMERATOR) & (b * DENOMINATOR >= a * NUMERATOR)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that pass the second order's prefixes and the exact threshold."""
    second = F.expr("slice(tokens, 1, second)")

    def with_side(df: DataFrame, col: Column, side: str) -> DataFrame:
        return df.join(sets.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"),
                                   col.alias(f"set_{side}")), side)

    def common(df: DataFrame, col: Column) -> DataFrame:
        return (with_side(with_side(df, col, "a"), col, "b")
                .withColumn("c", F.size(F.array_intersect("set_a", "set_b"))))

    near = common(pairs, second).where(F.col("c") >= F.least(_needed(F.col("size_a")), _needed(F.col("size_b"))))
    s = F.col("size_a") + F.col("size_b")
    return (common(near.select("a", "b"), F.col("tokens"))
            .where(F.col("c") * DENOMINATOR >= (s - F.col("c")) * NUMERATOR).select("a", "b"))


def _labels(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component of their node under ``links``."""
    parts = components(links)
    return (rows.join(parts.withColumnRenamed("component", "part"), "node", "left")
            .withColumn("part", F.coalesce("part", "node")))


def block_links(own: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of similar sets of a block pair; ``own`` tells the two blocks apart (one block: all pairs)."""
    size = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    token = np.cumsum(np.concatenate([[0], flat[1:] != flat[:-1]]))
    several = np.bincount(token)[token] > 1            # tokens of one set alone add nothing
    token, row = np.unique(token[several], return_inverse=True)[1], row[several]
    exact = np.float32 if size.max() < 1 << 20 else np.float64   # whole numbers stay whole
    common = np.zeros((len(sets), len(sets)), exact)
    for begin in range(0, int(token[-1]) + 1 if len(token) else 0, 1024):
        at = slice(*np.searchsorted(token, [begin, begin + 1024]))
        part = np.zeros((len(sets), 1024), exact)
        part[row[at], token[at] - begin] = 1
        common += part @ part.T
    # common / (both - common) >= 3 / 4, in whole numbers and a stretch of rows at a time
    share, two, left, right = size * exact(NUMERATOR), own.min() != own.max(), [], []
    for begin in range(0, len(sets), 256):
        end = min(begin + 256, len(sets))
        linked = common[begin:end] * (NUMERATOR + DENOMINATOR) >= share[begin:end, None] + share[None, :]
        linked &= np.arange(begin, end)[:, None] < np.arange(len(sets))[None, :]
        if two:
            linked &= own[begin:end, None] != own[None, :]
        i, j = np.nonzero(linked)
        left.append(i + begin)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _cluster_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` that join the components of a cluster. members: ``hub, node, part``.

    Clusters of one component are done. The others are cut into blocks of
    bounded size; a task counts the common tokens of all pairs of two blocks at
    once and returns one link a node, never the pairs.
    """
    mixed = (members.groupBy("hub").agg(F.count("*").alias("m"), F.min("part").alias("lo"), F.max("part").alias("hi"))
             .where("lo <> hi").select("hub", F.ceil(F.col("m") / CLUSTER_BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.select("hub", "node").join(mixed, "hub").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", "node", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    dealt = shared(dealt)
    shards = max(1, dealt.count() // SHARD_ROWS)
    schema = "a long, b long"
    target = _arrow_schema(members.sparkSession, schema)

    def run(table: pa.Table) -> pa.Table:
        keys = np.stack([table[c].to_numpy().astype(np.int64) for c in ("hub", "i", "j")])
        node, own_block, tokens = table["node"].to_numpy(), table["own"].to_numpy(), table["tokens"].combine_chunks()
        flat, offset = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        order = np.lexsort(keys)
        cut = np.flatnonzero(np.any(keys[:, order][:, 1:] != keys[:, order][:, :-1], axis=0)) + 1
        a, b = [], []
        for at in np.split(order, cut):
            if len(at) > 1:
                i, j = block_links(own_block[at], [flat[offset[k]:offset[k + 1]] for k in at.tolist()])
                root = local_components(len(at), i, j)
                far = np.flatnonzero(root != np.arange(len(at)))
                a.append(node[at][far])
                b.append(node[at][root[far]])
        empty = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])}, schema=target)

    return (dealt.join(sets.select("node", "tokens"), "node")
            .groupBy(F.pmod(F.xxhash64("hub", "i", "j"), F.lit(shards)).alias("shard"))
            .applyInArrow(lambda key, table: run(table), schema))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; documents of similarity >= 0.75 link."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    both = shared(_summaries(src, n))
    own = both.where("token is null").select("doc", "size", "node")
    top = (both.where("token is not null").groupBy("token").agg(F.sum("many").alias("many"))
           .orderBy(F.desc("many"), "token").limit(COMMON_TOKENS).toArrow())
    token = top["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    many = top["many"].to_numpy()[order]
    # the place by frequency: equal counts share it
    sent = spark.sparkContext.broadcast((token[order], np.searchsorted(np.unique(many), many)))
    sizes, sizes_at = stored(own.where("node is not null and doc is not null").groupBy("node").agg(
        F.min("doc").alias("rep"), F.min("size").alias("size")))
    is_rep = may_hold(sizes, "rep")     # a node's smallest document speaks for its copies; a few others pass too

    def first_prefix(doc, text):
        common, rank = sent.value
        pre = [prefix(s, ORDERS[0], common, rank) for s in (shingles(t, n) for t in text.to_pylist())]
        flat = np.concatenate([*pre, np.empty(0, np.uint64)])
        known = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat if len(common) else np.zeros(len(flat), bool)
        # 48 bits tell tokens apart for the filters; pairs are verified with all 64
        return {"token": as_long(flat >> np.uint64(16)), "rep": np.repeat(doc.to_numpy(), [len(p) for p in pre]), "common": known}

    index = map_rows(src.where(F.col("text").isNotNull() & is_rep(F.col("doc"))), first_prefix,
                     "token long, rep long, common boolean")
    # which tokens two nodes share; a window, so that the rows are shuffled once. Common tokens count as shared, and
    # their rows are spread by document
    spread = index.withColumn("salt", F.when(F.col("common"), F.col("rep")).otherwise(F.lit(0).cast("long")))
    of_token = Window.partitionBy("token", "salt")
    met, met_at = stored(spread.select("token", "rep", "common", F.min("rep").over(of_token).alias("lo"),
                                       F.max("rep").over(of_token).alias("hi"))
                         .where("common or lo <> hi").select("token", "rep").distinct())
    active, active_at = stored(met.groupBy("rep").agg(F.count("*").alias("met")).join(sizes, "rep")
                               .where(F.col("met") >= _least_needed(F.col("size"))).select("node", "rep", "size"))
    remove(spark)

    # full sets of the nodes that go on, the second order's prefix first
    may = may_hold(active, "rep")

    def full(node, size, text):
        common, rank = sent.value
        out = {"node": [], "size": [], "tokens": [], "second": []}
        for k, m, t in zip(node.to_pylist(), size.to_pylist(), text.to_pylist()):
            s = shingles(t, n)
            if len(s) == m and _node(s) == k:   # a row that repeats the id may have another text
                tokens, second = ordered(s, ORDERS[1], common, rank)
                for c, v in zip(out, (k, m, as_long(tokens), second)):
                    out[c].append(v)
        return out

    sets = map_rows(src.where(F.col("text").isNotNull() & may(F.col("doc")))
                    .join(active.withColumnRenamed("rep", "doc"), "doc").select("node", "size", "text"), full,
                    "node long, size long, tokens array<long>, second int")
    sets, sets_at = stored(sets)

    # clusters: every token's nodes go to the cluster of the token's hub, the node of the smallest document
    rows = met.join(active.select("rep"), "rep", "left_semi")
    hubs = rows.groupBy("token").agg(F.min("rep").alias("hub"))
    both_reps = rows.join(hubs, "token").select("hub", "rep").distinct()
    members, members_at = stored(
        both_reps.join(active, "rep").drop("rep")
        .join(active.select(F.col("rep").alias("hub"), F.col("node").alias("hub_node"), F.col("size").alias("hub_size")), "hub")
        .select(F.col("hub_node").alias("hub"), "hub_size", "node", "size"))
    remove(spark, met_at, active_at)
    star = (members.where((F.col("hub") != F.col("node")) & _possible(F.col("size"), F.col("hub_size")))
            .select(F.col("hub").alias("a"), F.col("node").alias("b")))
    links = shared(_verified(star, sets))
    remove(spark)
    links = links.unionByName(shared(_cluster_links(_labels(members, links), sets)))
    remove(spark, sets_at, members_at)

    # nodes' smallest documents carry the links; rows of one id, or of one set, meet in them
    rep = sizes.select("node", "rep")
    edges = (links.join(rep.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
             .join(rep.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b")
             .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
             .unionByName(own.join(rep, "node").where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))))
    classes = components(edges)
    remove(spark, sizes_at)
    out = own.join(classes, own["doc"] == classes["node"], "left")
    return out.select(own["doc"].cast(dict(docs.dtypes)[id_col]).alias("doc_id"), own["size"].alias("n_shingles"),
                      F.coalesce(classes["component"], own["doc"]).alias("component_id"))


def _node(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    total = np.array([np.add.reduce(tokens), np.bitwise_xor.reduce(tokens), len(tokens)], np.uint64)
    total = mix64(total + np.array([1, 2, 3], np.uint64))
    return int(as_long(mix64(total[:1] + mix64(total[1:2] + mix64(total[2:]))))[0])
