"""Phrase collocations counted by direct-address tiles of frequency-ranked ids.

Phrases grow word by word. A phrase of n words is the pair (unit, word) of its
first n - 1 words and its last one; units and words that occur often enough are
ranked by frequency, and the ranks cut the plane of pairs into tiles of
``SIDE`` x ``SIDE`` cells. Each task counts the pairs of its texts by tile: a tile
that gets many of them is a dense table that ``numpy.bincount`` adds to, the
others are sorted coordinate lists with counts. Only partial counts are shuffled.
The pairs that reach the least count are the units of the next round: they are
ranked anew and paired with the following word.

Ranks are broadcast for the ``TIER`` most frequent units, whatever the corpus. A
unit beyond them is counted by its 64-bit key in a sorted list, if it passes a
filter of fixed size that holds all frequent units; the filter decides nothing,
the summed count does. A phrase is counted only where its first and its last
n - 1 words are such units, since it cannot be more frequent than its parts.

Scores come from joins of the candidates' parts with the counted units. Numbers
are exact (decimal where products could pass 64 bits).

Nulls: a null text is empty, a null group is ``und``. Rows are counted as they
are: a repeated row counts again, ids are not read. Empty tables give no rows.
Only the named columns are read. 64-bit keys stand for words and phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, _LOWER, as_long, bound_batches, map_rows, mix64, shared

SIDE_BITS = 9
SIDE = 1 << SIDE_BITS
WORD_TIER = 1 << 16
UNIT_TIER = 1 << 18
#: Pairs of one tile in a buffer that make it dense, and dense tiles a task holds.
DENSE, MOST_DENSE = 1 << 15, 24
#: Pairs that a task buffers, and coordinates it holds before it hands them on.
BUFFER, HELD = 1 << 20, 1 << 21
#: Bytes of text hashed at once (a longer text alone).
STRETCH = 1 << 19
FILTER_BITS = 24
_SEED = np.uint64(0x51ED270B0A1F39C1)
_CHAIN = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLE = mix64(np.arange(64 << 8, dtype=np.uint64) + _SEED)
_KIND = np.zeros(256, np.uint8)          # 0: in a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2


@dataclass(frozen=True)
class Words:
    """The words of a stretch of texts in order."""
    key: np.ndarray       # 64-bit, of the word and its group
    piece: np.ndarray     # equal within a piece
    group: np.ndarray     # index of the text's group in ``groups``
    groups: list[str]
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def words_of(text: pa.Array, group: pa.Array) -> Iterator[Words]:
    """The lower-cased words of the texts, a bounded stretch of bytes at a time."""
    codes = group.fill_null("und").dictionary_encode()
    names = codes.dictionary.to_pylist()
    seeds = np.array([xxhash.xxh3_64_intdigest(g.encode()) for g in names], np.uint64)
    code = codes.indices.to_numpy(zero_copy_only=False)
    text = text.fill_null("").cast(pa.large_string())
    offset = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    if not len(text) or offset[0] == offset[-1]:
        return
    raw = np.frombuffer(text.buffers()[2], np.uint8)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(offset, offset[first] + STRETCH, side="right")) - 1)
        starts = offset[first:last] - offset[first]
        data = _LOWER[raw[offset[first]:offset[last]]]
        kind = _KIND[data]
        new = np.zeros(len(data) + 1, bool)
        new[starts] = True
        inside = kind == 0
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | new[1:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | new[1:-1]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if len(begin):
            doc = np.searchsorted(starts, begin, side="right") - 1     # of empty texts at one start the last one
            piece = np.cumsum(kind == 2)[begin] + doc
            size = end - begin
            at = np.arange(len(data))[inside] - np.repeat(begin, size)
            mixed = (at.astype(np.uint64) << np.uint64(8)) | data[inside]
            value = _TABLE[mixed] if size.max() <= 64 else mix64(mixed + _SEED)
            total = np.add.reduceat(value, np.cumsum(size) - size)
            of = code[first:last][doc]
            yield Words(mix64(mix64(total + size.astype(np.uint64)) + seeds[of]), piece, of, names, data, begin, end)
        first = last


def chain(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of the phrase that adds a word to ``left``."""
    return mix64(left * _CHAIN + word)


def phrase_keys(word: np.ndarray, piece: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the phrases of n words that begin at each word, and whether they stay in one piece."""
    m = max(0, len(word) - n + 1)
    key = word[:m]
    for j in range(1, n):
        key = chain(key, word[j:j + m])
    return key, piece[:m] == piece[n - 1:n - 1 + m]


class Units:
    """Frequent units: ranks of the most frequent ones and a filter of all."""

    def __init__(self, key: np.ndarray, many: np.ndarray, complete: bool, bits: np.ndarray):
        by_rank = np.lexsort((key, -many))
        self.by_rank = key[by_rank]
        order = np.argsort(self.by_rank)
        self.key, self.rank, self.complete, self.bits = self.by_rank[order], order.astype(np.int64), complete, bits

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(may be frequent, rank or -1 beyond the ranked ones)."""
        slot = key >> np.uint64(64 - FILTER_BITS)
        ok = (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        rank = np.full(len(key), -1, np.int64)
        at = np.flatnonzero(ok)
        if len(self.key):
            place = np.minimum(np.searchsorted(self.key, key[at]), len(self.key) - 1)
            hit = self.key[place] == key[at]
            rank[at[hit]] = self.rank[place[hit]]
        return ((rank >= 0) if self.complete else ok), rank


def combine(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys (all arrays but the last) with the sums of their counts (the last)."""
    cols = [np.concatenate(c) for c in zip(*rows)]
    order = np.lexsort(cols[-2::-1]) if len(cols) > 2 else np.argsort(cols[0], kind="stable")
    cols = [c[order] for c in cols]
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols[:-1]], axis=0)
    first = np.flatnonzero(new)
    return (*[c[first] for c in cols[:-1]], np.add.reduceat(cols[-1], first) if len(first) else cols[-1])


class Tiles:
    """Counts of rank pairs: dense tables for full tiles, sorted coordinates for the others."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.buffer: list[np.ndarray] = []
        self.buffered = 0
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, unit: np.ndarray, word: np.ndarray) -> None:
        tile = ((unit >> SIDE_BITS) << 7) | (word >> SIDE_BITS)            # WORD_TIER / SIDE = 2**7 tiles a row
        self.buffer.append((tile << 2 * SIDE_BITS) | ((unit & SIDE - 1) << SIDE_BITS) | (word & SIDE - 1))
        self.buffered += len(unit)
        if self.buffered >= BUFFER:
            self.settle()

    def settle(self) -> None:
        code = np.concatenate([*self.buffer, np.empty(0, np.int64)])
        self.buffer, self.buffered = [], 0
        tile = (code >> 2 * SIDE_BITS).astype(np.uint16)
        order = np.argsort(tile, kind="stable")                            # a radix sort of 16 bits
        code, many = code[order], np.bincount(tile)
        rest = np.ones(len(code), bool)
        end = np.cumsum(many)
        for t in np.flatnonzero((many >= DENSE) | np.isin(np.arange(len(many)), list(self.dense))):
            if t not in self.dense:
                if len(self.dense) == MOST_DENSE:
                    continue
                self.dense[t] = np.zeros(SIDE * SIDE, np.int64)
            here = slice(end[t] - many[t], end[t])
            self.dense[t] += np.bincount(code[here] & SIDE * SIDE - 1, minlength=SIDE * SIDE)
            rest[here] = False
        code = np.sort(code[rest])
        if len(code):
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            self.sparse.append((code[first], np.diff(np.append(first, len(code)))))

    def take(self, all_of_it: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit rank, word rank, count): the coordinates once there are many of them, and everything at the end."""
        rows = []
        if all_of_it:
            self.settle()
            for t, cells in self.dense.items():
                at = np.flatnonzero(cells)
                rows.append(((int(t) << 2 * SIDE_BITS) | at, cells[at]))
            self.dense = {}
        if self.sparse and (all_of_it or sum(len(c) for c, _ in self.sparse) > HELD):
            self.sparse = [combine(self.sparse)]
            if all_of_it or len(self.sparse[0][0]) > HELD // 2:
                rows += self.sparse
                self.sparse = []
        none = np.empty(0, np.int64)
        code, many = (np.concatenate([none, *c]) for c in zip(*rows)) if rows else (none, none)
        tile = code >> 2 * SIDE_BITS
        return (((tile >> 7) << SIDE_BITS) | ((code >> SIDE_BITS) & SIDE - 1),
                ((tile & 127) << SIDE_BITS) | (code & SIDE - 1), many)


def _scan(docs: DataFrame, schema: str, task: Callable) -> DataFrame:
    """``task()`` gives a task's (add(Words), take(last) -> arrays by column or None); whole texts, a stretch at a time."""
    bound_batches(docs.sparkSession)
    target = _arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, take = task()
        for batch in batches:
            for words in words_of(batch.column(0), batch.column(1)):
                add(words)
                yield from out(take(False))
        yield from out(take(True))

    def out(columns):
        if columns is not None and len(columns[0]):
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                              for c, f in zip(columns, target)], schema=target)

    return docs.mapInArrow(run, schema)


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """``key, lang, n``: words that occur ``least`` times in their group, and with a null key the words of each group."""
    def task():
        held: list[tuple[np.ndarray, ...]] = []
        names: dict[str, int] = {}
        totals: dict[int, int] = {}

        def add(w: Words) -> None:
            own = np.array([names.setdefault(g, len(names)) for g in w.groups], np.int64)
            for g, n in zip(own.tolist(), np.bincount(w.group, minlength=len(own)).tolist()):
                totals[g] = totals.get(g, 0) + n
            held.append((w.key, own[w.group], np.ones(len(w.key), np.int64)))
            if sum(len(k) for k, _, _ in held) > HELD:
                held[:] = [combine(held)]

        def take(last: bool):
            if not (last or held and len(held[0][0]) > HELD // 2):
                return None
            key, group, n = combine(held) if held else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
            held.clear()
            sums = totals if last else {}
            lang = pa.array(list(names), pa.string()).take(pa.array(np.append(group, np.array(list(sums), np.int64))))
            return (pa.concat_arrays([pa.array(as_long(key)), pa.nulls(len(sums), pa.int64())]), lang,
                    np.append(n, np.array(list(sums.values()), np.int64)))

        return add, take

    return (_scan(docs, "key long, lang string, n long", task).groupBy("key", "lang").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least) | F.col("key").isNull()))


def units(found: DataFrame, tier: int) -> Units:
    """Ranks and filter of frequent units (key, n); both are of bounded size."""
    top = found.orderBy(F.desc("n"), "key").limit(tier + 1).select("key", "n").toArrow()
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bits = found.groupBy(F.shiftright(slot, 3).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 7 as int))")).alias("b")).toArrow()
    table = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    table[bits["at"].to_numpy()] = bits["b"].to_numpy()
    key, many = top["key"].to_numpy().view(np.uint64)[:tier], top["n"].to_numpy()[:tier]
    return Units(key, many, top.num_rows <= tier, table)


def pair_counts(docs: DataFrame, n: int, left: Units, words: Units, least: int) -> DataFrame:
    """``left, right, a``: phrases of n words that occur ``least`` times, as pairs of a unit's and a word's key."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((left, words))

    def task():
        unit, word = sent.value
        tiles = Tiles()
        lists: list[tuple[np.ndarray, ...]] = []

        def add(w: Words) -> None:
            if len(w.key) < n:
                return
            key, whole = phrase_keys(w.key, w.piece, n - 1)
            fine, rank = unit.find(key)
            fine &= whole
            m = len(w.key) - n + 1
            at = np.flatnonzero(fine[:m] & fine[1:m + 1] & (w.piece[:m] == w.piece[n - 1:]))
            last = w.key[at + n - 1]
            second = word.find(last)[1] if n > 2 else rank[at + 1]
            both = (rank[at] >= 0) & (second >= 0)
            tiles.add(rank[at[both]], second[both])
            if not both.all():
                lists.append((key[at[~both]], last[~both], np.ones(int((~both).sum()), np.int64)))
                if sum(len(x[0]) for x in lists) > HELD:
                    lists[:] = [combine(lists)]

        def take(last: bool):
            u, v, many = tiles.take(last)
            listed = None
            if lists and (last or len(lists[0][0]) > HELD // 2):
                listed = combine(lists)
                lists.clear()
            if not len(u) and listed is None:
                return None
            a, b, c = listed or (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
            return (pa.concat_arrays([pa.array((u << 16) | v), pa.nulls(len(a), pa.int64())]),
                    pa.concat_arrays([pa.nulls(len(u), pa.int64()), pa.array(as_long(a))]),
                    pa.concat_arrays([pa.nulls(len(v), pa.int64()), pa.array(as_long(b))]), np.append(many, c))

        return add, take

    counted = (_scan(docs, "code long, left long, right long, a long", task).groupBy("code", "left", "right")
               .agg(F.sum("a").alias("a")).where(F.col("a") >= least))

    def names(code, l, r, a):
        unit, word = sent.value
        known = np.flatnonzero(code.is_valid())
        c = code.drop_null().to_numpy()
        out = [l.fill_null(0).to_numpy().copy(), r.fill_null(0).to_numpy().copy()]
        out[0][known], out[1][known] = as_long(unit.by_rank[c >> 16]), as_long(word.by_rank[c & 0xFFFF])
        return {"left": out[0], "right": out[1], "a": a}

    return map_rows(counted, names, "left long, right long, a long")


def _parts(candidates: DataFrame) -> DataFrame:
    """Candidates with ``first`` and ``rest``: the keys of the two parts at each cut."""
    def run(key, words, *others):
        first, rest = [], []
        for ws in words.to_pylist():
            k = np.array(ws, np.int64).view(np.uint64)
            heads, tails = [], []
            for cut in range(1, len(k)):
                heads.append(_key(k[:cut]))
                tails.append(_key(k[cut:]))
            first.append(heads)
            rest.append(tails)
        return {"key": key, "words": words, "first": first, "rest": rest} | dict(zip(("lang", "a"), others))

    return map_rows(candidates.select("key", "words", "lang", "a"), run,
                    "key long, words array<long>, lang string, a long, first array<long>, rest array<long>")


def _key(words: np.ndarray) -> int:
    key = words[:1]
    for j in range(1, len(words)):
        key = chain(key, words[j:j + 1])
    return int(as_long(key)[0])


def _extended(pairs: DataFrame, below: DataFrame) -> DataFrame:
    """Pairs of the next length as candidates ``key, lang, words, a``; ``below`` holds their units."""
    joined = pairs.join(below.select(F.col("key").alias("left"), "lang", "words"), "left").select(
        "left", "right", "lang", F.concat("words", F.array("right")).alias("words"), "a")

    def run(left, right, *others):
        key = chain(left.to_numpy().view(np.uint64), right.to_numpy().view(np.uint64))
        return {"key": as_long(key)} | dict(zip(("lang", "words", "a"), others))

    return map_rows(joined, run, "key long, lang string, words array<long>, a long")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def spellings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``word_key, word`` of the wanted keys (column ``word_key``)."""
    bits = units(wanted.select(F.col("word_key").alias("key"), F.lit(1).cast("long").alias("n")), 0).bits
    sent = docs.sparkSession.sparkContext.broadcast(Units(np.empty(0, np.uint64), np.empty(0, np.int64), False, bits))

    def task():
        seen: dict[int, bytes] = {}

        def add(w: Words) -> None:
            at = np.flatnonzero(sent.value.find(w.key)[0])
            key, one = np.unique(w.key[at], return_index=True)
            for k, i in zip(key.tolist(), at[one].tolist()):
                if k not in seen:
                    seen[k] = w.data[w.begin[i]:w.end[i]].tobytes()

        def take(last: bool):
            if not seen or not (last or len(seen) > HELD // 8):
                return None
            out = as_long(np.array(list(seen), np.uint64)), [b.decode() for b in seen.values()]
            seen.clear()
            return out

        return add, take

    return (_scan(docs, "word_key long, word string", task).join(wanted, "word_key", "left_semi")
            .groupBy("word_key").agg(F.min("word").alias("word")))


def mine(docs: DataFrame, least: int = 30, longest: int = 4, cover: int = 80, top: int = 2000, text_col: str = "text",
         group_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each group's ``top`` phrases of 2 to ``longest`` words.

    A phrase occurs ``least`` times at least. Its score is floor(2000000 a / (l + r))
    at the cut where that is lowest. It is dropped if a longer candidate holds
    it and has ``cover`` per cent of its occurrences.
    """
    src = docs.select(F.col(text_col).cast("string").alias("text"), F.col(group_col).cast("string").alias("lang"))
    counted = shared(word_counts(src, least))
    totals = counted.where("key is null").select("lang", F.col("n").alias("total"))
    single = counted.where("key is not null")
    words = units(single, WORD_TIER)
    below, left, found = single.withColumn("words", F.array("key")), words, None
    for n in range(2, longest + 1):
        here = shared(_extended(pair_counts(src, n, left, words, least), below))
        found = here if found is None else found.unionByName(here)
        left, below = units(here.select("key", F.col("a").alias("n")), UNIT_TIER), here

    known = single.select("key", F.col("n").alias("f")).unionByName(found.select("key", F.col("a").alias("f")))
    parts = shared(_parts(found))
    cuts = (parts.select("key", "a", F.posexplode(F.arrays_zip("first", "rest")).alias("k", "part"))
            .select("key", "a", "k", F.col("part.first").alias("first"), F.col("part.rest").alias("rest"))
            .join(known.select(F.col("key").alias("first"), F.col("f").alias("l")), "first")
            .join(known.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
            .withColumn("both", _exact(F.col("l")) + _exact(F.col("r")))
            .withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000bd) div both"))
            .groupBy("key").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    # the parts without the last or the first word; a phrase inside a longer one is inside one that has a word more
    longer = (parts.where(F.size("words") > 2)
              .select("a", F.explode(F.array(F.element_at("first", -1), F.element_at("rest", 1))).alias("key"))
              .groupBy("key").agg(F.max("a").alias("held")))
    scored = (parts.select("key", "words", "lang", "a").join(cuts, "key").join(longer, "key", "left")
              .where(F.col("held").isNull() | (_exact(F.col("held")) * 100 < _exact(F.col("a")) * cover))
              .select("lang", "words", "a", "best.l", "best.r", "best.score"))
    order = [F.desc("score"), F.desc("a")]
    picked = shared(scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
                    .where(F.col("place") <= top))
    spelt = shared(spellings(src, picked.select(F.explode("words").alias("word_key")).distinct()))
    phrases = (picked.select("*", F.posexplode("words").alias("i", "word_key"))
               .join(spelt, "word_key").groupBy("lang", "words", "a", "l", "r", "score")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ")
                    .alias("phrase")))
    row = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (phrases.withColumn("rank", row).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
