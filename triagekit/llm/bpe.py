"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than ``chunk`` characters is cut into chunks that overlap their
right neighbour. Chunks are dealt over the cluster and pre-tokenised on their
own; two neighbours are stitched at the first pre-token boundary both found in
the overlap that does not follow white space. A match of the pattern depends
only on what follows its start, so from a common boundary on both sequences
agree and the pieces between the stitches encode to exactly the ids of the whole
text. A text in which some
overlap shows no common boundary (one endless run of letters) is encoded as one
piece. Decoding concatenates the raw bytes of the ids.

Nulls: a null text is empty (no ids, no bytes). Rows with a null id and
repeated rows each give their own result row. Only the named columns are read.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, rank_encoding, shared

CHUNK = 32768
OVERLAP = 1024
#: The longest look of one alternative that a cut could change: a contraction's three characters.
REACH = 3


def _encoder(path: str, pattern: str):
    def run(text: pa.Array) -> list[bytes]:
        encode = rank_encoding(path, pattern).encode_ordinary
        return [array("I", encode(t)).tobytes() if t else b"" for t in text.to_pylist()]
    return run


def boundaries(compiled, text: str, start: int, last: bool) -> list[int]:
    """Starts of the pre-tokens from ``start`` on which more text to the right can't change."""
    out, end = [start], len(text)
    for m in compiled.finditer(text, start):
        if not last and (m.end() >= end or m.start() + REACH > end):
            break
        out.append(m.end())
    return out


def stitch(compiled, text: str, chunk: int, overlap: int) -> int | None:
    """Where this chunk's pre-tokens and those begun at ``chunk`` first agree; None: nowhere in the overlap.

    Not after white space: a run of it ends differently before a letter than at
    the end of a piece.
    """
    last = len(text) < chunk + overlap   # the window reaches the end of the text
    mine = set(b for b in boundaries(compiled, text, 0, last)
               if b >= chunk and (not text[b - 1].isspace() or last and b == len(text)))
    return next((b for b in boundaries(compiled, text, chunk, last) if b in mine), None)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` (binary: little-endian unsigned 32-bit ids of the whole text)."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be within one chunk")
    id_type = dict(docs.dtypes)[id_col]
    run = _encoder(path, pattern)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = map_rows(src.where(~long), lambda i, t: {"doc_id": i, "ids": run(t)}, f"doc_id {id_type}, ids binary")

    def cut(row, doc, text):
        out = {k: [] for k in ("row", "doc_id", "k", "n", "text")}
        for r, d, t in zip(row.to_pylist(), doc.to_pylist(), text.to_pylist()):
            n = -(-len(t) // chunk)
            for k in range(n):
                for c, v in zip(out, (r, d, k, n, t[k * chunk:(k + 1) * chunk + overlap])):
                    out[c].append(v)
        return out

    def mark(row, doc, k, n, text):
        import regex
        compiled = regex.compile(pattern)
        stop = [None if i + 1 == m else stitch(compiled, t, chunk, overlap)
                for i, m, t in zip(k.to_pylist(), n.to_pylist(), text.to_pylist())]
        return {"row": row, "doc_id": doc, "k": k, "n": n, "text": text, "stop": stop}

    cols = f"row long, doc_id {id_type}, k int, n int, text string"
    # numbered rows are written first: a task that is run again must not number them anew
    rows = shared(src.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    parts = map_rows(rows, cut, cols)
    marked = map_rows(parts.repartition("row", "k"), mark, cols + ", stop int")
    doc = Window.partitionBy("row")
    lost = F.max(F.when(F.col("stop").isNull() & (F.col("k") < F.col("n") - 1), 1).otherwise(0)).over(doc) == 1
    marked = (marked.withColumn("lost", lost)
              .withColumn("begin", F.coalesce(F.lag("stop").over(doc.orderBy("k")) - chunk, F.lit(0))))
    piece = F.when(F.col("lost"), F.expr(f"substring(text, 1, {chunk})")).otherwise(
        F.expr("substring(text, begin + 1, coalesce(stop, length(text)) - begin)"))
    pieces = (marked.withColumn("piece", piece)
              .groupBy("row", "doc_id", F.when(F.col("lost"), 0).otherwise(F.col("k")).alias("k"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "piece"))),
                                            lambda x: x["piece"]), "").alias("piece")))
    ids = map_rows(pieces.select("row", "doc_id", "k", "piece"),
                   lambda r, d, k, t: {"row": r, "doc_id": d, "k": k, "ids": run(t)},
                   f"row long, doc_id {id_type}, k int, ids binary")
    whole = ids.groupBy("row", "doc_id").agg(
        F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", F.hex("ids").alias("h")))),
                                         lambda x: x["h"]), "")).alias("ids"))
    return short.unionByName(whole.select("doc_id", "ids"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (binary): the raw bytes of the ids, concatenated; a null ``ids`` gives empty bytes."""
    id_type = dict(encoded.dtypes)["doc_id"]

    def run(doc, ids):
        back = rank_encoding(path, pattern).decode_bytes
        return {"doc_id": doc, "ids": ids, "decoded": [back(array("I", b or b"").tolist()) for b in ids.to_pylist()]}

    return map_rows(encoded.select("doc_id", "ids"), run, f"doc_id {id_type}, ids binary, decoded binary")


def id_digest(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """``ids_sha256``: digest of the decimal ids joined by commas, beside the columns ``keep``."""
    types = dict(encoded.dtypes)

    def run(ids, *rest):
        from hashlib import sha256
        out = [sha256(",".join(map(str, array("I", b or b""))).encode()).hexdigest() for b in ids.to_pylist()]
        return dict(zip(keep, rest)) | {"ids_sha256": out}

    return map_rows(encoded.select("ids", *keep), run,
                    ", ".join(f"{c} {types[c]}" for c in keep) + ", ids_sha256 string")
