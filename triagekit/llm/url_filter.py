"""URL rules by a Bloom filter cascade, in DataFrame functions only.

The universe is every (host suffix, path prefix) of the corpus' urls that has
the shape of some rule: as many host labels and as many path characters as a
rule has. Level 0 encodes the listed keys, level 1 the universe's keys that
level 0 lets through wrongly, level 2 the listed keys that level 1 holds
wrongly, and so on until nothing is wrong. Within the universe the cascade's
answer is then exact, and a lookup is a few hashes and bit tests on literal
arrays: no join, no shuffle. The bits are bounded by the list (``BITS_PER_KEY``
a key, ``MAX_BITS`` at most), not by the corpus.

Nulls: a null url, or one without ``://``, has an empty host and path. Repeated
rows each give a result row. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_KEY = 16
HASHES = 4
LEAST_BITS = 1024
MAX_BITS = 1 << 28
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits; ``seed`` sets its hashes apart from other levels'."""
    words: np.ndarray
    seed: int

    @property
    def bits(self) -> int:
        return 64 * len(self.words)

    def holds(self, key: Column) -> Column:
        words, out = F.lit(self.words), F.lit(True)
        for at in _positions(key, self.bits, self.seed):
            out = out & (F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out


def _positions(key: Column, bits: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * HASHES + i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def _level(keys: DataFrame, count: int, seed: int) -> Level:
    """A Bloom filter of the column ``key``; the words are built by a grouped bit_or."""
    bits = 64 * -(-max(LEAST_BITS, BITS_PER_KEY * count) // 64)
    if bits > MAX_BITS:
        raise ValueError("the list is too long for a filter of bounded size")
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, seed))).alias("at"))
    words = np.zeros(bits // 64, np.int64)
    for r in (at.groupBy(F.shiftright("at", 6).alias("w"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).collect()):
        words[r.w] = r.b
    return Level(words, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Exact membership for keys of the universe the cascade was built on (false for null)."""
        out = F.lit(len(self.levels) % 2 == 1)   # what passes every level belongs to the last one's side
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return F.coalesce(key.isNotNull() & out, F.lit(False))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade for the column ``key`` of ``listed`` over the column ``key`` of ``universe``."""
    listed = listed.where("key is not null").distinct()
    inside, outside = listed, None
    levels: list[Level] = []
    count = inside.count()
    while count:
        levels.append(_level(inside, count, len(levels)))
        if outside is None:
            outside = (universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"))).distinct()
                       .join(listed, "key", "left_anti"))
        else:
            outside = outside.where(levels[-1].holds(F.col("key")))
        inside, outside = outside, inside
        count = inside.count()
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a url; empty where there is none."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def shapes(rules: list[str]) -> list[tuple[int, int]]:
    """(host labels, path characters) that occur among rules like ``example.org/en/``."""
    return sorted({(r.partition("/")[0].count(".") + 1, len(r) - len(r.partition("/")[0])) for r in rules})


def shaped_keys(host: Column, path: Column, rules: list[str]) -> list[tuple[int, Column]]:
    """(host labels, key) for each shape; the key is null where the url is too short for it."""
    labels = F.size(F.split(host, r"\."))
    return [(depth, F.when((labels >= depth) & (F.length(path) >= chars),
                           F.concat(F.substring_index(host, ".", -depth), F.substring(path, 1, chars))))
            for depth, chars in shapes(rules)]


def judge(pages: DataFrame, rules: dict[str, str], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for ``rules`` like ``{"org/": "allow"}``.

    A rule fits its host and all subdomains if the path starts with its path;
    the longest rule wins, at equal length the one with more host labels.
    ``verdict`` is the rule's, or ``default`` for urls on no rule. One cascade
    finds the listed keys, a second one those that block.
    """
    spark: SparkSession = pages.sparkSession
    host, path = split_url(F.col("url"))
    src = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
           .select("page_id", host.alias("host"), path.alias("path")))
    keys = shaped_keys(F.col("host"), F.col("path"), list(rules))
    listed = spark.createDataFrame([(k, v) for k, v in rules.items()], "key string, verdict string")
    universe = src.select(F.explode(F.array(*[k for _, k in keys])).alias("key")) if keys else listed.limit(0)
    known = build(listed.select("key"), universe)
    blocked = build(listed.where("verdict = 'block'").select("key"), universe)
    best = [F.when(known.holds(k), F.struct(F.length(k).alias("n"), F.lit(depth).alias("d"), k.alias("k")))
            for depth, k in keys]
    none = F.lit(None).cast("struct<n:int,d:int,k:string>")
    found = src.withColumn("rule", F.greatest(none, none, *best)["k"])
    return found.withColumn("verdict", F.when(F.col("rule").isNull(), F.lit(default))
                            .when(blocked.holds(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))
