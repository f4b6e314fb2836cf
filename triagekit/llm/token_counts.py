"""Token counts by a two-tier lookup on the map side.

A text is cut at single spaces, which the tokenizer's own pre-tokeniser never
crosses, so a text's count is the sum over its pieces. Tier one is a compact
table of the most frequent pieces' lengths, broadcast to the tasks: every task
counts the pieces of its whole texts in a bounded frequency summary, the
summaries' heads are added up and the ``table_size`` largest are kept. Tier two
is a cache in each Python worker for the rest; what neither knows is encoded by
the tokenizer, a batch at a time. No piece is shuffled, only the summaries
(at most ``SUMMARY_ROWS`` rows a task). The table changes speed, never counts.

Nulls: a null text is empty (0 tokens, 0 bytes). Rows with a null id and
repeated rows each give their own result row. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, bound_batches, map_rows

TABLE_SIZE = 16384
SUMMARY_ROWS = 4096
SUMMARY_KEYS = 100_000   # pieces a task's summary holds at once
TABLE_CHARS = 48         # longer pieces never enter the table
CACHE_KEYS = 300_000     # pieces a worker's cache holds at once
CACHE_CHARS = 256        # longer pieces are encoded each time


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def lengths(path: str, texts: list[str]) -> list[int]:
    """Token counts of texts by the library the file belongs to."""
    t = _tokenizer(path)
    if path.endswith(".model"):
        return [len(x) for x in t.encode(texts, num_threads=1)]
    return [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]


_CACHE: dict[str, dict[str, int]] = {}


def _cut_ok(path: str) -> bool:
    """Cutting at single spaces is exact for pre-tokenisers that drop white space; others count whole texts."""
    if path.endswith(".model"):
        return False
    state = _tokenizer(path).pre_tokenizer
    return "Removed" in str(state) and r"\s" in str(state)


def frequent(docs: DataFrame, text_col: str = "text", size: int = TABLE_SIZE) -> dict[str, int]:
    """The most frequent pieces of all whole texts, by summaries of bounded size; at most ``size``."""
    bound_batches(docs.sparkSession)
    schema = "piece string, n long"
    target = _arrow_schema(docs.sparkSession, schema)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(text.split(" "))
            if len(seen) > SUMMARY_KEYS:   # keep the heavier half; a frequent piece comes back at once
                seen = Counter(dict(seen.most_common(SUMMARY_KEYS // 2)))
        top = [(p, n) for p, n in seen.most_common(SUMMARY_ROWS) if n > 1 and 0 < len(p) <= TABLE_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], schema=target)

    heads = docs.select(F.col(text_col).alias("text")).mapInArrow(summary, schema)
    top = heads.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    return {r.piece: r.n for r in top.collect()}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every whole text."""
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    cut = _cut_ok(path)
    pieces = list(frequent(docs, text_col, table_size)) if cut else []
    table = spark.sparkContext.broadcast(dict(zip(pieces, lengths(path, pieces))) if pieces else {})

    def run(doc, size, text):
        texts = text.to_pylist()
        if not cut:
            n = iter(lengths(path, [t for t in texts if t]))
            return {"doc_id": doc, "n_bytes": size, "n_tokens": [next(n) if t else 0 for t in texts]}
        head, cache = table.value, _CACHE.setdefault(path, {})
        if len(cache) > CACHE_KEYS:
            cache.clear()
        words = [t.split(" ") if t else [] for t in texts]
        missing = list({w for ws in words for w in ws if w not in head and w not in cache})
        new = dict(zip(missing, lengths(path, missing))) if missing else {}
        cache.update((w, n) for w, n in new.items() if len(w) <= CACHE_CHARS)
        known = _Tiers(head, cache, new)
        return {"doc_id": doc, "n_bytes": size, "n_tokens": [sum(map(known.__getitem__, ws)) for ws in words]}

    src = docs.select(F.col(id_col).alias("doc_id"),
                      F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                      F.col(text_col).alias("text"))
    return map_rows(src, run, f"doc_id {id_type}, n_bytes long, n_tokens long")


class _Tiers(dict):
    """Looks into the broadcast table, then the worker's cache, then the batch's own new pieces."""

    def __init__(self, head, cache, new):
        super().__init__(head)
        self._cache, self._new = cache, new

    def __missing__(self, key):
        n = self._cache.get(key)
        return self._new[key] if n is None else n
