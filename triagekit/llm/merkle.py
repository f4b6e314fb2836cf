"""Merkle manifest of a dataset by bitmap ranks and slot arrays.

Rows of a group (a language) are the leaves of that group's tree, in the order
of their ids; the groups' roots, in the order of the group names, are the leaves
of the top tree. Eight consecutive nodes make a parent.

Coordinates without sorting: every group's ids become a compressed bitmap, its
non-empty 64-bit words (partial words are merged by ``or`` before the shuffle).
Popcount directories count the rows of all words, of all 2**16-id chunks and of
the two levels above; each level has at most 2**16 entries under one parent, so
no window sees more. An id's leaf is a rank query: directory entries plus the
popcount of the lower bits of its word.

Nodes then meet by block key (``BLOCK`` consecutive places) and are put into the
block's slot array by place; a block is reduced ``LEVELS`` levels at a time, so a
round shrinks the table by 512 and only one round in three levels shuffles. Paths
come back down the same way: a block's rows meet the one path of their block.

Nulls: a null id precedes all others, a null group is a group of its own before
all named ones, a null field is ``-``. Rows that repeat an id follow each other
by leaf (then by altered leaf), equal ones in any order; their word keeps counts
beside its bits, and a run of equal rows is ranked as one row with a count. An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, shared

FAN = 8
LEVELS = 3
BLOCK = FAN ** LEVELS
#: Equal rows that one task lists at once.
COPIES = 4096
NULL_CHUNK = -(1 << 48)    # below every id's chunk
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(columns: list[Column]) -> Column:
    """Hex sha256 of the columns' texts, each with its byte count; ``-`` for a null."""
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in (c.cast("string") for c in columns)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def group_key(c: Column) -> Column:
    """A text per group that sorts as the group names do bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


# --- coordinates -----------------------------------------------------------------------------

def _places(rows: DataFrame) -> DataFrame:
    """``rows`` (k, id, ...) with the chunk, the word and the bit of the id."""
    return (rows.withColumn("chunk", F.coalesce(F.shiftright("id", 16), F.lit(NULL_CHUNK).cast("long")))
            .withColumn("word", F.coalesce(F.shiftright("id", 6).bitwiseAND(F.lit(1023).cast("long")), F.lit(0).cast("long")))
            .withColumn("bit", F.coalesce(F.col("id").bitwiseAND(F.lit(63).cast("long")), F.lit(0).cast("long")).cast("int")))


def bitmaps(rows: DataFrame) -> DataFrame:
    """The groups' bitmaps: ``k, chunk, word, bits, n, before, total``.

    rows: ``k`` (group), ``id``. One row for each non-empty word; ``n`` counts
    the rows of its ids, ``before`` the rows of all smaller ids of the group,
    ``total`` the rows of the group.
    """
    words = shared(_places(rows).groupBy("k", "chunk", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("n")))

    def before(*above: str, by: str) -> Column:
        return F.sum("n").over(Window.partitionBy("k", *above).orderBy(by)) - F.col("n")

    def level(child: DataFrame, *keys: Column) -> DataFrame:
        return child.groupBy("k", *keys).agg(F.sum("n").alias("n"))

    c2, c3 = F.shiftright("chunk", 16).alias("c2"), F.shiftright("c2", 16).alias("c3")
    chunks = level(words, F.col("chunk"), c2)
    mids = level(chunks, F.col("c2"), c3)
    tops = level(mids, F.col("c3"))
    totals = level(tops).withColumnRenamed("n", "total")
    tops = tops.withColumn("b3", before(by="c3")).join(totals, "k").select("k", "c3", "b3", "total")
    mids = (mids.withColumn("b2", before("c3", by="c2")).join(tops, ["k", "c3"])
            .select("k", "c2", (F.col("b3") + F.col("b2")).alias("b2"), "total"))
    chunks = (chunks.withColumn("b1", before("c2", by="chunk")).join(mids, ["k", "c2"])
              .select("k", "chunk", (F.col("b2") + F.col("b1")).alias("b1"), "total"))
    return (words.withColumn("b0", before("chunk", by="word")).join(chunks, ["k", "chunk"])
            .select("k", "chunk", "word", "bits", "n", (F.col("b1") + F.col("b0")).alias("before"), "total"))


def coordinates(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """``k, pos, total, id, node, other`` of every row (k, id, node, other): its place among its group's leaves."""
    single = F.col("n") == F.bit_count("bits")
    placed = _places(rows)
    lower = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    out = (placed.join(maps.where(single), ["k", "chunk", "word"])
           .select("k", (F.col("before") + lower).alias("pos"), "total", "id", "node", "other"))
    repeated = maps.where(~single)
    if repeated.isEmpty():
        return out
    # words with repeated ids: runs of equal rows are one row with a count
    at = ["k", "chunk", "word", "bit"]
    runs = shared(placed.join(repeated.select(*at[:3]), at[:3]).groupBy(*at, "id", "node", "other")
                  .agg(F.count("*").alias("m")).withColumn("cell", F.substring("node", 1, 4)))

    def offsets(keys: list[str], above: list[str], by: str, name: str) -> DataFrame:
        sums = runs.groupBy(*keys).agg(F.sum("m").alias("s"))
        return sums.withColumn(name, F.sum("s").over(Window.partitionBy(*above).orderBy(by)) - F.col("s")).drop("s")

    inside = Window.partitionBy(*at, "cell").orderBy("node", "other").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (runs.withColumn("o2", F.coalesce(F.sum("m").over(inside), F.lit(0)))
              .join(offsets([*at, "cell"], at, "cell", "o1"), [*at, "cell"])
              .join(offsets(at, at[:3], "bit", "o0"), at)
              .join(repeated, at[:3])
              .withColumn("first", F.col("before") + F.col("o0") + F.col("o1") + F.col("o2")))
    copies = (ranked.withColumn("c", F.explode(F.expr(f"sequence(0L, (m - 1) div {COPIES})")))
              .repartition("k", "first", "c")
              .withColumn("i", F.explode(F.expr(f"sequence(c * {COPIES}, least(m, (c + 1) * {COPIES}) - 1)"))))
    return out.unionByName(copies.select("k", (F.col("first") + F.col("i")).alias("pos"), "total", "id", "node", "other"))


# --- trees -----------------------------------------------------------------------------------

def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], total: int) -> list[list[str]]:
    """The block's levels from its nodes up, as many as the block or the tree has."""
    out = [nodes]
    while total > 1 and len(out) <= LEVELS:
        below = out[-1]
        out.append([_hash("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return out


def _slots(table: pa.Table, *columns: str) -> tuple[list[list], int]:
    """The block's slot arrays of ``columns`` by place, and the tree's total."""
    pos = table["pos"].to_pylist()
    base = pos[0] // BLOCK * BLOCK if pos else 0
    out = []
    for c in columns:
        slots: list = [None] * len(pos)
        for p, v in zip(pos, table[c].to_pylist()):
            slots[p - base] = v
        out.append(slots)
    return out, table["total"][0].as_py() if pos else 0


def _sides(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """For each level the siblings left and right of the node above leaf ``i``."""
    out = []
    for below in levels[:-1]:
        run = i // FAN * FAN
        out.append(("".join(below[run:i]), "".join(below[i + 1:run + FAN])))
        i //= FAN
    return out


NODE = "k string, pos long, total long, node string"
PATH = "k string, pos long, left array<string>, right array<string>, subroot string"
PATH_COLUMNS = ["k", "pos", "left", "right", "subroot"]


def _block() -> Column:
    return F.shiftright("pos", 3 * LEVELS).alias("block")


def _reduce(nodes: DataFrame) -> DataFrame:
    """The next table of nodes: one node a block."""
    def run(key, table):
        (slots,), total = _slots(table, "node")
        levels = _levels(slots, total)
        for _ in levels[1:]:
            total = -(-total // FAN)
        return pa.table({"k": [key[0].as_py()], "pos": [key[1].as_py()], "total": [total], "node": levels[-1]})

    return nodes.select("k", "pos", "total", "node").groupBy("k", _block()).applyInArrow(run, NODE)


def reduce_tree(nodes: DataFrame) -> list[DataFrame]:
    """Written tables of nodes (k, pos, total, node) from the given one up to the roots."""
    tables = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 1
    while most > 1:
        tables.append(shared(_reduce(tables[-1].where("total > 1"))))
        most = -(-most // BLOCK)
    return tables


def _paths_of(tables: list[DataFrame], tops: DataFrame, r: int) -> DataFrame:
    """Paths of the blocks that hold the nodes of table ``r``: from above, or a finished tree's own."""
    done = tables[r].where("total = 1").select("k").join(tops, "k")
    return done if r == len(tables) - 1 else done.unionByName(_descend(tables, tops, r + 1))


def _descend(tables: list[DataFrame], tops: DataFrame, r: int) -> DataFrame:
    """``PATH`` rows: the siblings of every node of table ``r`` up to the roots, then those of ``tops``."""
    target = _arrow_schema(tops.sparkSession, PATH)

    def run(key, below, above):
        (slots,), total = _slots(below, "node")
        up = above.to_pylist()[0] if above.num_rows else None
        levels, rows = _levels(slots, total), []
        for i in range(len(slots) if up else 0):
            sides = _sides(levels, i)
            rows.append({"k": up["k"], "pos": key[1].as_py() * BLOCK + i, "left": [a for a, _ in sides] + up["left"],
                         "right": [b for _, b in sides] + up["right"], "subroot": up["subroot"]})
        return pa.Table.from_pylist(rows, target)

    above = _paths_of(tables, tops, r).toDF(*PATH_COLUMNS).groupBy("k", F.col("pos").alias("block"))
    return (tables[r].select("k", "pos", "total", "node").groupBy("k", _block()).cogroup(above).applyInArrow(run, PATH))


def _ranked(names: DataFrame) -> DataFrame:
    """``k`` (distinct) and the others with ``pos``, the rank of ``k``; ranges are counted, not gathered."""
    parts = max(1, int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = shared(names.repartitionByRange(parts, "k").withColumn("part", F.spark_partition_id()))
    many = dealt.groupBy("part").agg(F.count("*").alias("n"))      # at most ``parts`` rows
    before = many.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    inside = F.row_number().over(Window.partitionBy("part").orderBy("k"))
    return dealt.withColumn("i", inside).join(before, "part").withColumn("pos", F.col("before") + F.col("i") - 1).drop(
        "part", "before", "i")


def manifest(docs: DataFrame, fields: list[str], altered: dict[str, Column] | None = None, id_col: str = "doc_id",
             group_col: str = "lang") -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, and its ``group_key`` and ``position``.

    The leaf is the digest of ``fields`` in their order. ``altered`` replaces
    columns of a received copy; the copy's leaf is folded with the original
    siblings, and ``verified`` tells whether that gives the root.
    """
    altered = altered or {}
    rows = shared(docs.select(
        group_key(F.col(group_col)).alias("k"), F.col(id_col).cast("long").alias("id"),
        digest([F.col(c) for c in fields]).alias("node"),
        digest([altered.get(c, F.col(c)) for c in fields]).alias("other")))
    leaves = shared(coordinates(rows, bitmaps(rows)))
    tables = reduce_tree(leaves)
    subroots = None
    for t in tables:
        roots = t.where("total = 1").select("k", "node")
        subroots = roots if subroots is None else subroots.unionByName(roots)
    named = _ranked(subroots)
    groups = named.count()
    top = reduce_tree(shared(named.select(F.lit("").alias("k"), "pos", F.lit(groups).cast("long").alias("total"), "node")))
    root = next((r[0] for r in top[-1].select("node").collect()), "")   # one row, none if the table is empty
    own = top[-1].sparkSession.createDataFrame([("", 0, [], [], "")], PATH)
    ways = _descend(top, own, 0) if groups else own
    tops = shared(named.select(F.col("k"), "pos", F.col("node").alias("subroot"))
                  .join(ways.select("pos", "left", "right"), "pos")
                  .select("k", F.lit(0).cast("long").alias("pos"), "left", "right", "subroot"))

    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean, group_key string, position long")
    target = _arrow_schema(docs.sparkSession, schema)

    def run(key, below, above):
        (slots, others, ids), total = _slots(below, "node", "other", "id")
        up = above.to_pylist()[0] if above.num_rows else {"left": [], "right": [], "subroot": ""}
        higher = list(zip(up["left"], up["right"]))
        tail = "".join(a + b for a, b in higher)
        levels, known = _levels(slots, total), {}

        def fold(node: str, sides: list[tuple[str, str]]) -> str:
            for a, b in sides:
                node = _hash(a + node + b)
            return node

        out = []
        for i, (leaf, other) in enumerate(zip(slots, others)):
            sides = _sides(levels, i)
            here = fold(other, sides)
            if here not in known:
                known[here] = fold(here, higher)
            out.append((ids[i], leaf, up["subroot"], root, _hash("".join(a + b for a, b in sides) + tail), known[here],
                        known[here] == root, key[0].as_py(), key[1].as_py() * BLOCK + i))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), target)] if out else
                        [pa.array([], f.type) for f in target], schema=target)

    above = _paths_of(tables, tops, 0).toDF(*PATH_COLUMNS).groupBy("k", F.col("pos").alias("block"))
    found = leaves.groupBy("k", _block()).cogroup(above).applyInArrow(run, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)[id_col]))
