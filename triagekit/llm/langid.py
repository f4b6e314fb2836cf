"""Language identification by a linear-chain conditional random field over words.

Each word has affix and byte n-gram features (n-grams of 1 to 5 bytes of the
word between boundary marks, hashed) and a lexicon feature per language (the
word is among that language's frequent words). Transitions between the labels
of neighbouring words are learned with the feature weights on code-switched
sequences that join runs of words of differently labelled documents, by gradient
steps on the conditional likelihood. Prediction runs forward-backward exactly:
a long text is cut into blocks whose transfer matrices carry the messages
across, so that all blocks of a batch advance together. A run of letters of more
than ``MAX_WORD_BYTES`` bytes (glued words, text without spaces) is cut into pieces
that are labelled one by one. A document's language is the label with the largest
mean posterior over its words.

Fitting reads a bounded sample of labelled rows (``SAMPLE_DOCS`` documents a
language, one run of at most ``RUN_WORDS`` words of each, chosen by hash);
prediction reads every whole text.

Nulls: a null text, or one without a letter, gets ``und`` with score 0. Rows
with a null id and repeated rows each give a result row. Without any labelled
row everything is ``und``. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, mix64

SAMPLE_DOCS = 300
RUN_WORDS = 48
LEXICON_WORDS = 150
BUCKETS = 1 << 16
MAX_NGRAM = 5
MAX_WORD_BYTES = 64      # a longer word is labelled in consecutive pieces
PIECE_CHARS = 16         # characters of such a piece
EPOCHS = 6
BLOCK = 128              # words in a block of forward-backward
CACHE_WORDS = 200_000    # words that a task remembers
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray        # buckets x labels
    lexicon: np.ndarray        # sorted hashes of lexicon words
    lexicon_of: np.ndarray     # 0/1, words x labels
    lexicon_weight: np.ndarray  # labels x labels: weight on label j of "is in lexicon i"
    transition: np.ndarray     # labels x labels

    @cached_property
    def name(self) -> str:
        """Digest of the content: what a worker remembers of words belongs to one model."""
        parts = (self.weights, self.lexicon, self.lexicon_of, self.lexicon_weight, self.transition)
        return sha256(repr(self.labels).encode() + b"".join(p.tobytes() for p in parts)).hexdigest()


def normal(word: str) -> str:
    """The letters of a word, lower-cased; empty if it has none."""
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def pieces(word: str) -> list[str]:
    """What is labelled of a word: its letters, in one piece if they are few, none if it has no letter."""
    plain = normal(word)
    if len(plain) <= PIECE_CHARS or len(plain.encode()) <= MAX_WORD_BYTES:
        return [plain] if plain else []
    return [plain[i:i + PIECE_CHARS] for i in range(0, len(plain), PIECE_CHARS)]


def _bytes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words between boundary marks, first byte and size of each."""
    raw = [b"\x02" + w.encode() + b"\x03" for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    return data, np.cumsum(size) - size, size


def _ngrams(data: np.ndarray, first: np.ndarray, size: np.ndarray):
    """For each length the byte positions at which an n-gram of a word begins, and its bucket."""
    end = np.repeat(first + size, size)
    at = np.arange(len(data))
    code = np.zeros(len(data), np.uint64)
    for n in range(1, MAX_NGRAM + 1):
        code *= np.uint64(257)
        code[:len(data) - n + 1] += data[n - 1:] + np.uint64(1)
        ok = np.flatnonzero(at + n <= end)
        x = (code[ok] + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
        yield ok, ((x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.int64)


def _word_keys(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, to look it up in the lexicon."""
    at = np.arange(len(data)) - np.repeat(first, size)
    return mix64(np.add.reduceat(mix64(data * np.uint64(1 << 32) + at.astype(np.uint64)), first) + size.astype(np.uint64))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature buckets of all words, first feature of each word, hash of each word)."""
    data, first, size = _bytes(words)
    owner = np.repeat(np.arange(len(words)), size)
    grams = list(_ngrams(data, first, size))
    owners = np.concatenate([owner[ok] for ok, _ in grams])
    counts = np.bincount(owners, minlength=len(words))
    buckets = np.concatenate([b for _, b in grams])[np.argsort(owners, kind="stable")]
    return buckets, np.cumsum(counts) - counts, _word_keys(data, first, size)


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """Label scores of normalised words (words x labels)."""
    if not words:
        return np.zeros((0, len(model.labels)))
    data, first, size = _bytes(words)
    score = np.zeros((len(data), len(model.labels)))
    for ok, bucket in _ngrams(data, first, size):
        score[ok] += model.weights[bucket]
    out = np.add.reduceat(score, first, axis=0)
    if len(model.lexicon):
        key = _word_keys(data, first, size)
        at = np.minimum(np.searchsorted(model.lexicon, key), len(model.lexicon) - 1)
        hit = np.flatnonzero(model.lexicon[at] == key)
        out[hit] += model.lexicon_of[at[hit]] @ model.lexicon_weight
    return out


def posteriors(emission: np.ndarray, sizes: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Exact label posteriors of every word of concatenated sequences of ``sizes`` words (each over 0)."""
    n_labels = emission.shape[1]
    step = np.exp(transition - transition.max())
    local = np.exp(emission - emission.max(1, keepdims=True))
    first = np.cumsum(sizes) - sizes
    blocks = -(-sizes // block)
    doc = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[doc] + nth * block
    length = np.minimum(sizes[doc] - nth * block, block)

    order = np.argsort(-length, kind="stable")
    begin, length, doc, nth = begin[order], length[order], doc[order], nth[order]
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(block + 1)]   # blocks longer than t
    c = len(doc)
    before, after = np.full((c, n_labels), 1.0 / n_labels), np.ones((c, n_labels))

    if blocks.max() > 1:
        # transfer matrices of the blocks of long sequences, then messages from block to block
        multi = np.flatnonzero(blocks[doc] > 1)
        moved = np.broadcast_to(np.eye(n_labels), (len(multi), n_labels, n_labels)).copy()
        for t in range(block):
            k = int(np.searchsorted(-length[multi], -t, side="left"))
            if not k:
                break
            moved[:k] = (moved[:k] @ step) * local[begin[multi[:k]] + t][:, None, :]
            moved[:k] /= moved[:k].max((1, 2), keepdims=True)
        place = np.full((len(sizes), int(blocks.max())), -1)
        place[doc[multi], nth[multi]] = np.arange(len(multi))
        for k in range(place.shape[1] - 1):
            here = place[:, k]
            here = here[(place[:, k + 1] >= 0)]
            there = place[:, k + 1][place[:, k + 1] >= 0]
            message = np.einsum("ci,cij->cj", before[multi[here]], moved[here])
            before[multi[there]] = message / message.sum(1, keepdims=True)
        for k in range(place.shape[1] - 1, 0, -1):
            here = place[:, k]
            there = place[:, k - 1][here >= 0]
            here = here[here >= 0]
            message = np.einsum("cij,cj->ci", moved[here], after[multi[here]])
            after[multi[there]] = message / message.sum(1, keepdims=True)

    out = np.empty_like(local)
    a = before
    for t in range(block):
        k = active[t]
        if not k:
            break
        a = (a[:k] @ step) * local[begin[:k] + t]
        a /= a.sum(1, keepdims=True)
        out[begin[:k] + t] = a
    b = after.copy()
    for t in range(block - 1, -1, -1):
        k = active[t]
        if not k:
            continue
        at = begin[:k] + t
        here = out[at] * b[:k]
        out[at] = here / here.sum(1, keepdims=True)
        b[:k] = (local[at] * b[:k]) @ step.T
        b[:k] /= b[:k].sum(1, keepdims=True)
    return out


def sample(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           docs: int = SAMPLE_DOCS, run_words: int = RUN_WORDS) -> list[tuple[str, list[str]]]:
    """Up to ``docs`` documents of each language, chosen by hash, with one run of their words each."""
    src = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rank = F.xxhash64(F.col(id_col).cast("string"), F.lit("sample"))
    sizes = src.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"))
    # a share by hash first, so that the window below sees a few hundred rows a language
    share = F.least(F.lit(1.0), F.lit(3.0 * docs) / F.col("n"))
    unit = F.pmod(rank, F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = (src.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                         rank.alias("rank"), unit.alias("unit"))
              .join(F.broadcast(sizes), "lang").where(F.col("unit") <= share))

    def cut(lang, rank, text):
        out = []
        for r, t in zip(rank.to_pylist(), text.to_pylist()):
            words = [p for w in t.split() for p in pieces(w)]
            at = r % max(1, len(words) - run_words + 1)
            out.append(words[at:at + run_words])
        return {"lang": lang, "rank": rank, "words": out}

    runs = map_rows(picked.select("lang", "rank", "text"), cut, "lang string, rank long, words array<string>")
    top = (runs.where(F.size("words") > 0)
           .withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "words")))
           .where(F.col("i") <= docs))
    rows = top.select("lang", "words", "rank").collect()   # at most ``docs`` short runs a language
    return [(r.lang, r.words) for r in sorted(rows, key=lambda r: (r.rank, r.lang, r.words))]


def fit(runs: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Train on code-switched sequences built of ``runs``; deterministic for the same runs."""
    labels = tuple(sorted({lang for lang, _ in runs}))
    of = {lang: i for i, lang in enumerate(labels)}
    n = len(labels)
    rng = np.random.default_rng(seed)
    from collections import Counter
    frequent = [Counter(w for lang, ws in runs if lang == name for w in ws).most_common(LEXICON_WORDS) for name in labels]
    lexicon: dict[str, np.ndarray] = {}
    for i, words in enumerate(frequent):
        for w, _ in words:
            lexicon.setdefault(w, np.zeros(n))[i] = 1.0
    if lexicon:
        key = features(list(lexicon))[2]
        order = np.argsort(key)
        lex, lex_of = key[order], np.stack(list(lexicon.values()))[order]
    else:
        lex, lex_of = np.empty(0, np.uint64), np.zeros((0, n))
    model = Model(labels, np.zeros((BUCKETS, n)), lex, lex_of, np.zeros((n, n)), np.zeros((n, n)))
    if n < 2:
        return model

    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in runs for w in ws}))}
    words = list(vocabulary)
    buckets, first, key = features(words)
    counts = np.diff(np.append(first, len(buckets)))
    at = np.minimum(np.searchsorted(lex, key), len(lex) - 1)
    in_lex = (lex[at] == key)[:, None] * lex_of[at]
    grads = [np.zeros_like(x) + 1e-6 for x in (model.weights, model.lexicon_weight, model.transition)]

    def ascend(param, grad, total, rate):
        total += grad * grad
        param += rate * grad / np.sqrt(total)

    for _ in range(epochs):
        # sequences: a run's pieces and another one's take turns, so that labels switch within a sequence
        order = rng.permutation(len(runs))
        for begin in range(0, len(order), 64):
            seqs = []
            chosen = [runs[i] for i in order[begin:begin + 64]]
            for j, (lang, ws) in enumerate(chosen):
                other, os = chosen[(j + 1) % len(chosen)]
                cut, back = int(rng.integers(0, len(ws) + 1)), int(rng.integers(0, len(os) + 1))
                seqs.append([(vocabulary[w], of[lang]) for w in ws[:cut]] + [(vocabulary[w], of[other]) for w in os[:back]]
                            + [(vocabulary[w], of[lang]) for w in ws[cut:]])
            flat = np.array([x for s in seqs for x in s])
            sizes = np.array([len(s) for s in seqs])
            ids, gold = flat[:, 0], flat[:, 1]
            used, inverse = np.unique(ids, return_inverse=True)
            em_words = np.stack([model.weights[buckets[first[u]:first[u] + counts[u]]].sum(0) for u in used])
            em_words += in_lex[used] @ model.lexicon_weight
            em = em_words[inverse]
            post = posteriors(em, sizes, model.transition)
            error = -post
            error[np.arange(len(gold)), gold] += 1.0
            by_word = np.zeros((len(used), n))
            np.add.at(by_word, inverse, error)
            rows = np.concatenate([buckets[first[u]:first[u] + counts[u]] for u in used])
            grad = np.zeros_like(model.weights)
            np.add.at(grad, rows, np.repeat(by_word, counts[used], axis=0))
            # expected transitions from the posteriors of neighbours, observed ones from the labels
            inner = np.ones(len(gold), bool)
            inner[np.cumsum(sizes) - sizes] = False
            prev, nxt = np.flatnonzero(inner) - 1, np.flatnonzero(inner)
            pair = _pair_posteriors(em, sizes, model.transition, prev, nxt)
            seen = np.zeros((n, n))
            np.add.at(seen, (gold[prev], gold[nxt]), 1.0)
            ascend(model.weights, grad, grads[0], 0.2)
            ascend(model.lexicon_weight, in_lex[used].T @ by_word, grads[1], 0.2)
            ascend(model.transition, seen - pair, grads[2], 0.2)
    return model


def _pair_posteriors(emission, sizes, transition, prev, nxt) -> np.ndarray:
    """Sum over neighbouring words of the posterior of their two labels."""
    step = np.exp(transition - transition.max())
    local = np.exp(emission - emission.max(1, keepdims=True))
    forward, backward = np.empty_like(local), np.ones_like(local)
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    first, length = first[order], sizes[order]
    a = np.full((len(sizes), local.shape[1]), 1.0 / local.shape[1])
    for t in range(int(length[0])):
        k = int(np.searchsorted(-length, -t, side="left"))
        a = (a[:k] @ step) * local[first[:k] + t]
        a /= a.sum(1, keepdims=True)
        forward[first[:k] + t] = a
    for t in range(int(length[0]) - 2, -1, -1):
        k = int(np.searchsorted(-length, -(t + 1), side="left"))
        b = (local[first[:k] + t + 1] * backward[first[:k] + t + 1]) @ step.T
        backward[first[:k] + t] = b / b.sum(1, keepdims=True)
    pair = forward[prev][:, :, None] * step[None] * (local[nxt] * backward[nxt])[:, None, :]
    return (pair / pair.sum((1, 2), keepdims=True)).sum(0)


_CACHE: dict[str, tuple[dict[str, int], list[list[int]], np.ndarray]] = {}


def _word_rows(model: Model, docs: list[list[str]]) -> tuple[dict[str, int], list[list[int]], np.ndarray]:
    """Row of each word of a batch in a table of label scores: -1 for words without a letter; a word of several pieces
    has -2 - i, the place of its rows in the list that follows."""
    nothing = {}, [], np.zeros((0, len(model.labels)))
    rows, long, table = _CACHE.get(model.name) or nothing
    _CACHE.clear()
    if len(rows) > CACHE_WORDS:
        rows, long, table = nothing
    new = list({w for ws in docs for w in ws if w not in rows})
    if new:
        known: list[str] = []
        for w in new:
            parts, at = pieces(w), len(table) + len(known)
            if len(parts) > 1:
                rows[w] = -2 - len(long)
                long.append(list(range(at, at + len(parts))))
            else:
                rows[w] = at if parts else -1
            known += parts
        table = np.concatenate([table, emissions(model, known)])
    if len(rows) <= CACHE_WORDS:
        _CACHE[model.name] = rows, long, table
    return rows, long, table


#: Words that forward-backward holds at once.
GROUP_WORDS = 200_000


def word_labels(model: Model, texts: list[str | None]):
    """For each text the posteriors of its words with a letter, or of their pieces (words x labels); yields (index, posteriors)."""
    docs = [t.split() if t else [] for t in texts]
    rows, long, table = _word_rows(model, docs)
    group: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        sizes = np.array([len(x) for _, x in group])
        post = posteriors(table[np.concatenate([x for _, x in group])], sizes, model.transition)
        for (i, _), p in zip(group, np.split(post, np.cumsum(sizes)[:-1])):
            yield i, p

    for i, ws in enumerate(docs):
        at = np.fromiter(map(rows.__getitem__, ws), np.int64, len(ws))
        if len(at) and at.min() < -1:
            at = np.concatenate([long[-2 - r] if r < -1 else [r] for r in at.tolist()]).astype(np.int64)
        at = at[at >= 0]
        if len(at):
            group.append((i, at))
            held += len(at)
        if held > GROUP_WORDS:
            yield from flush()
            group, held = [], 0
    if group:
        yield from flush()


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` (mean posterior of the label), and the columns ``keep``."""
    keep = keep or {}
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      *[c.alias(name) for name, c in keep.items()])
    types, names = dict(src.dtypes), list(keep)

    def run(doc, text, *rest):
        m = sent.value
        lang, score = [UNDETERMINED] * len(text), [0.0] * len(text)
        if m.labels:
            for i, post in word_labels(m, text.to_pylist()):
                mean = post.mean(0)
                best = int(mean.argmax())
                lang[i], score[i] = m.labels[best], float(min(1.0, max(0.0, mean[best])))
        return {"doc_id": doc, "lang_pred": lang, "score": score} | dict(zip(names, rest))

    return map_rows(src, run, f"doc_id {types['doc_id']}, lang_pred string, score double"
                    + "".join(f", {c} {types[c]}" for c in names), done=_CACHE.clear)


def label_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, labels``: the most probable language of each word that has a letter (of each piece of a very long one), in order."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = dict(docs.dtypes)[id_col]

    def run(doc, text):
        m, out = sent.value, [[] for _ in range(len(text))]
        if m.labels:
            for i, post in word_labels(m, text.to_pylist()):
                out[i] = [m.labels[j] for j in post.argmax(1)]
        return {"doc_id": doc, "labels": out}

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                    f"doc_id {id_type}, labels array<string>", done=_CACHE.clear)
