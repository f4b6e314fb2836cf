"""Substring dedup with suffix automata of reference shards.

A word goes if some window of ``window`` consecutive words that covers it also
starts in a document with a smaller id.

1. Every window has an anchor, the smallest hash of its ``GRAM``-word grams, so
   equal windows have equal anchors. A document is cut into runs of consecutive
   windows with one anchor. Only runs whose anchor occurs in two documents can
   hold a repeated window; counting anchors takes one small row a run.
   Anchors that one batch of documents shares are settled there.
2. Runs with equal words are one passage, owned by the smallest document. An
   anchor with very many different passages (a common line in changing
   surroundings) is first cut down to the windows that two of them share.
3. Passages are dealt by anchor to reference shards of bounded size. A task
   builds the suffix automaton of its shard over word hashes, in order of owner:
   each passage is streamed for its matching statistics, which gives each window
   the smallest document that holds it, and the stretches not yet known are
   appended. A state's owner is the document that created it.
4. Owners go back to all runs of the passage; the covered spans are merged by
   document and removed.

The automata go by key to the tasks that stream their shard rather than to all
tasks: the reference grows with the corpus, and only data of bounded size is
broadcast. Words are compared by 64-bit hashes, windows by sequences of them.

Nulls: a null text has no words. Rows with a null id take no part in comparisons
and keep all words. Rows that repeat an id are one document: they remove nothing
from each other, and each gives a result row. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (_arrow_schema, as_long, map_rows, may_hold, mix64, powers, shared, window_hashes, word_bounds,
                     word_hashes)

WINDOW = 50
GRAM = 20
SHARD_PASSAGES = 1500     # passages in a shard on average; a passage has some 70 words
HOT_PASSAGES = 2000       # an anchor with more different passages is cut down to shared windows first
_BASE = 0xA0761D6478BD642F


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each ``n`` consecutive values."""
    have, size = x, 1
    while size * 2 <= n:
        have = np.minimum(have[:-size], have[size:])
        size *= 2
    return np.minimum(have[:len(x) - n + 1], have[n - size:]) if size < n else have


def runs(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, hash of the words, first window, number of windows) of each run of windows with one anchor."""
    if len(words) < window:
        return tuple(np.empty(0, d) for d in (np.uint64, np.uint64, np.int64, np.int64))
    anchor = sliding_min(window_hashes(words, gram), window - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(anchor)))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_BASE, len(words)), dtype=np.uint64, out=total[1:])
    inverse = powers(pow(_BASE, -1, 1 << 64), len(words))
    content = mix64((total[first + count + window - 1] - total[first]) * inverse[first] + count.astype(np.uint64))
    return anchor[first], content, first, count


def content_hash(words: np.ndarray, windows: int) -> int:
    """The hash that ``runs`` gives to these words (as a signed 64-bit integer)."""
    total = np.sum(words * powers(_BASE, len(words)), dtype=np.uint64)
    return int(as_long(mix64(np.array([total], np.uint64) + np.uint64(windows)))[0])


class Automaton:
    """Generalised suffix automaton over integers; each state knows the first document that holds its strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [-1]

    def _state(self, length: int, step: dict[int, int], link: int, owner) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of q's strings that end a match from p, taken out of q."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], self.owner[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def append(self, words: list[int], owner) -> None:
        """Add a text; texts come in order of their owners."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in words:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, c)
                continue
            new = self._state(length[last] + 1, {}, 0, owner)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = new

    def owners(self, words: list[int], window: int) -> list:
        """For each window of a text the owner of its state, None if the automaton does not hold it."""
        nxt, link, length = self.next, self.link, self.length
        out: list = [None] * (len(words) - window + 1)
        state = matched = 0
        for i, c in enumerate(words):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            state = nxt[state].get(c, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= window:   # the state of the last ``window`` words
                state = link[state]
            matched = min(matched, length[state], window)
            if matched == window:
                out[i - window + 1] = self.owner[state]
        return out


def shard_owners(passages: list[tuple[int, np.ndarray]], window: int) -> list[list[tuple[int, int, int]]]:
    """For passages (owner, word hashes): runs (first window, windows, smallest document) covering each passage."""
    auto, out = Automaton(), [None] * len(passages)
    for k in sorted(range(len(passages)), key=lambda k: passages[k][0]):
        owner, hashes = passages[k]
        words = hashes.tolist()
        found = auto.owners(words, window)
        spans, i = [], 0
        while i < len(found):
            j = i
            while j < len(found) and found[j] == found[i]:
                j += 1
            if found[i] is None:
                auto.append(words[i:j + window - 1], owner)
            spans.append((i, j - i, owner if found[i] is None else found[i]))
            i = j
        out[k] = spans
    return out


def _run_rows(src: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc, text_hash, anchor, content, first, n`` of every run, and what counting its anchor needs.

    An anchor that two documents of one batch have is known to be shared
    (``state`` 1), so its runs need not meet the others; they are spread by
    document. Two of them go along as witnesses (``state`` 2) for runs of the
    same anchor elsewhere. A frequent anchor thus brings two rows a batch to
    its group, not one a document. ``state`` 0 is left to be counted.
    """
    def run(doc, text_hash, text):
        out = []
        for t in text.to_pylist():
            a, c, f, n = runs(word_hashes(t.encode())[0], window, gram)
            out.append((as_long(a), as_long(c), f, n))
        sizes = [len(o[0]) for o in out]
        anchor, content, first, n = (np.concatenate([*(o[k] for o in out), np.empty(0, np.int64)]) for k in range(4))
        docs_ = np.repeat(doc.to_numpy(), sizes)
        order = np.lexsort((docs_, anchor))
        a, d = anchor[order], docs_[order]
        new = np.concatenate([[True], a[1:] != a[:-1]])[:len(a)]      # first row of an anchor
        other = np.concatenate([[False], (a[1:] == a[:-1]) & (d[1:] != d[:-1])])[:len(a)]   # first row of a further document
        group = np.cumsum(new) - 1
        several = np.bincount(group, other, int(new.sum())) > 0
        state = np.zeros(len(anchor), np.int32)
        state[order] = several[group]
        second = other & (np.cumsum(other) - np.cumsum(other)[np.flatnonzero(new)][group] == 1)
        extra = order[(new | second) & several[group]]
        rows = np.concatenate([np.arange(len(anchor)), extra])
        return {"doc": docs_[rows], "text_hash": np.repeat(text_hash.to_numpy(), sizes)[rows], "anchor": anchor[rows],
                "content": content[rows], "first": first[rows].astype(np.int32), "n": n[rows].astype(np.int32),
                "state": np.concatenate([state, np.full(len(extra), 2, np.int32)])}
    return map_rows(src, run, "doc long, text_hash long, anchor long, content long, first int, n int, state int")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc, text_hash, spans`` (array of word positions start, end): what to remove, for documents that lose a word.

    docs: ``doc, text_hash`` (long) and ``text``, no nulls; rows with one ``doc`` are told apart by ``text_hash``.
    """
    src = docs.select("doc", "text_hash", "text")
    spread = _run_rows(src, window, gram).withColumn(
        "salt", F.when(F.col("state") == 1, F.col("doc")).otherwise(F.lit(0).cast("long")))
    same = Window.partitionBy("anchor", "salt")
    found = shared(spread.select("*", F.min("doc").over(same).alias("lo"), F.max("doc").over(same).alias("hi"))
                   .where("state = 1 or (state = 0 and lo <> hi)").drop("state", "salt", "lo", "hi"))
    passages = (found.groupBy("anchor", "content", "n")
                .agg(F.min(F.struct("doc", "first")).alias("at"))
                .select("anchor", "content", "n", F.col("at.doc").alias("doc"), F.col("at.first").alias("first")))
    hot = (passages.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > HOT_PASSAGES)
           .select("anchor", F.lit(True).alias("hot")))
    passages = shared(passages.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False))))
    n_passages = passages.count()
    shards = max(1, -(-n_passages // SHARD_PASSAGES))

    # the passages' words, from the owners' texts
    asked = passages.groupBy("doc").agg(F.collect_list(F.struct("anchor", "content", "first", "n", "hot")).alias("asked"))

    def words(doc, text, asked):
        out = {k: [] for k in ("anchor", "content", "n", "doc", "words", "hot")}
        for d, t, ask in zip(doc.to_pylist(), text.to_pylist(), asked.to_pylist()):
            h = word_hashes(t.encode())[0]
            for a in ask:
                part = h[a["first"]:a["first"] + a["n"] + window - 1]
                if content_hash(part, a["n"]) == a["content"]:   # another row of the same id may not have it
                    for k, v in (("anchor", a["anchor"]), ("content", a["content"]), ("n", a["n"]), ("doc", d),
                                 ("words", part.tobytes()), ("hot", a["hot"])):
                        out[k].append(v)
        return out

    asked = shared(asked)
    may = may_hold(asked, "doc")
    held = shared(map_rows(src.where(may(F.col("doc"))).join(asked, "doc").select("doc", "text", "asked"), words,
                           "anchor long, content long, n int, doc long, words binary, hot boolean"))
    cold = held.where(~F.col("hot"))
    parts = cold.select("anchor", F.col("content").alias("part"), F.col("n").alias("count"), "doc", "words")
    if passages.where("hot").isEmpty():
        owners = _owners(parts, shards, window).select(
            "anchor", F.col("part").alias("content"), F.col("count").alias("n"), "first", "windows", "owner")
    else:
        # anchors with very many passages: only stretches that two passages share go to an automaton, once each
        cut = shared(_stretches(held.where("hot"), window))
        parts = parts.unionByName(
            cut.where("words is not null").groupBy("anchor", "part", "count")
            .agg(F.min(F.struct("doc", "words")).alias("x")).select("anchor", "part", "count", "x.doc", "x.words"))
        whole = cold.select(
            "anchor", "content", "n", F.lit(0).alias("shift"), F.col("content").alias("part"), F.col("n").alias("count"))
        place = whole.unionByName(cut.where("words is not null").select(*whole.columns))
        owners = (place.join(_owners(parts, shards, window), ["anchor", "part", "count"])
                  .select("anchor", "content", "n", (F.col("shift") + F.col("first")).alias("first"), "windows", "owner")
                  .unionByName(cut.where("words is null").select(
                      "anchor", "content", "n", F.col("shift").alias("first"), F.col("count").alias("windows"),
                      F.col("doc").alias("owner"))))
    covered = (found.join(owners.withColumnRenamed("first", "from"), ["anchor", "content", "n"])
               .where(F.col("owner") < F.col("doc"))
               .select("doc", "text_hash", F.struct((F.col("first") + F.col("from")).alias("start"),
                                       (F.col("first") + F.col("from") + F.col("windows") + window - 1).alias("end"))
                       .alias("span")))
    return covered.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def _owners(parts: DataFrame, shards: int, window: int) -> DataFrame:
    """``anchor, part, count, first, windows, owner``: the automata's answer for every window of each part."""
    schema = "anchor long, part long, count int, first int, windows int, owner long"
    target = _arrow_schema(parts.sparkSession, schema)

    def resolve(table: pa.Table) -> pa.Table:
        passages = [(d, np.frombuffer(w, np.uint64)) for d, w in zip(table["doc"].to_pylist(), table["words"].to_pylist())]
        spans = shard_owners(passages, window)
        size = np.array([len(s) for s in spans], int)
        flat = np.array([x for s in spans for x in s], np.int64).reshape(-1, 3)
        rep = {c: np.repeat(table[c].to_numpy(), size) for c in ("anchor", "part", "count")}
        return pa.table(rep | {"first": flat[:, 0].astype(np.int32), "windows": flat[:, 1].astype(np.int32),
                               "owner": flat[:, 2]}, schema=target)

    return (parts.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
            .applyInArrow(lambda key, table: resolve(table), schema))


def _stretches(held: DataFrame, window: int) -> DataFrame:
    """Passages cut where windows that occur in two passages of their anchor begin or end.

    ``anchor, content, n, shift, count, part, doc, words``: stretches that are not shared have null words; the
    passage's own document is the smallest that holds them.
    """
    def hashes(anchor, content, n, w):
        h = [as_long(window_hashes(np.frombuffer(x, np.uint64), window)) for x in w.to_pylist()]
        size = [len(x) for x in h]
        return {"anchor": np.repeat(anchor.to_numpy(), size), "content": np.repeat(content.to_numpy(), size),
                "n": np.repeat(n.to_numpy(), size), "w": np.concatenate([*h, np.empty(0, np.int64)])}

    each = map_rows(held.select("anchor", "content", "n", "words"), hashes, "anchor long, content long, n int, w long")
    common = (each.groupBy("anchor", "w").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
              .where("lo <> hi").select("anchor", "w"))
    keep = (each.join(common, ["anchor", "w"], "left_semi").groupBy("anchor", "content", "n")
            .agg(F.collect_set("w").alias("keep")))
    names = ("anchor", "content", "n", "shift", "count", "part", "doc", "words")

    def cut(anchor, content, n, doc, words, keep):
        out = {k: [] for k in names}
        for a, c, m, d, w, ks in zip(*(x.to_pylist() for x in (anchor, content, n, doc, words, keep))):
            h = np.frombuffer(w, np.uint64)
            mark = np.isin(as_long(window_hashes(h, window)), np.array(ks or [], np.int64))
            edge = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1], [True]]))
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
                part = h[s:e + window - 1]
                for k, v in zip(names, (a, c, m, s, e - s, content_hash(part, e - s), d, part.tobytes() if mark[s] else None)):
                    out[k].append(v)
        return out

    return map_rows(held.join(keep, ["anchor", "content", "n"], "left")
                    .select("anchor", "content", "n", "doc", "words", "keep"), cut,
                    "anchor long, content long, n int, shift int, count int, part long, doc long, words binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row, and the columns ``keep``.

    ``kept`` is the words that stay, joined by one space.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *keep)
    spans = shared(repeated_spans(src.where("doc_id is not null and text is not null")
                           .select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"), "text"),
                           window, gram).select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), "spans"))
    types = dict(src.dtypes)

    def run(doc, text, spans, *rest):
        n, gone, kept = [], [], []
        for t, s in zip(text.to_pylist(), spans.to_pylist()):
            raw = (t or "").encode()
            start, end = word_bounds(np.frombuffer(raw, np.uint8))
            stay = np.ones(len(start), bool)
            for x in s or ():
                stay[x["start"]:x["end"]] = False
            n.append(len(start))
            gone.append(len(start) - int(stay.sum()))
            kept.append(" ".join(raw[a:b].decode() for a, b in zip(start[stay].tolist(), end[stay].tolist())))
        return {"doc_id": doc, "n_words": n, "n_removed": gone, "kept": kept} | dict(zip(keep, rest))

    # only documents that may lose a word meet the spans
    may = may_hold(spans, "_doc")(F.col("doc_id").cast("long"))
    joined = (src.where(may).join(spans, (F.col("doc_id").cast("long") == F.col("_doc"))
                                  & (F.xxhash64("text") == F.col("_hash")), "left").select("doc_id", "text", "spans", *keep)
              .unionByName(src.where(~may).withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
                           .select("doc_id", "text", "spans", *keep)))
    return map_rows(joined, run,
                    f"doc_id {types['doc_id']}, n_words long, n_removed long, kept string"
                    + "".join(f", {c} {types[c]}" for c in keep))
