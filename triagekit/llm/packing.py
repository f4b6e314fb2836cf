"""Vector best-fit packing of token pieces into sequences.

A piece takes tokens, one place in the document count and attention cost
(length squared); a sequence has a capacity of each. Pieces with the same
length are alike, so the plan is made on the histogram of lengths (at most
``tokens`` rows, however many documents there are): lengths go from long to
short, and alike sequences are kept as one group with a multiplicity. The next
piece goes to the group it fits under every constraint that is best by the rule:
``norm`` takes the smallest weighted norm of what is left after placing it,
``dot`` the largest weighted dot product of demand and residual. The plan, a
few thousand rows, is then dealt to the pieces by their rank within their
length; ranks come from per-bucket counts and a window inside each bucket, so a
length that a third of all pieces share is spread over many tasks.

Nulls: a null text is empty. Null ids and repeated rows are packed like any
other row. Only the named columns are read, so clashing names do no harm.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, rank_encoding, shared

#: Pieces that one bucket of a length holds on average when ranks are dealt.
BUCKET_ROWS = 50_000
#: The plan has a few rows a length; beyond this it would not be a small table.
PLAN_ROWS = 1_000_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weights of the three residuals in the rule."""
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"


def cut_pieces(docs: DataFrame, path: str, pattern: str, special: tuple[tuple[str, int], ...] = (),
               end_id: int | None = None, tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids`` (binary, little-endian unsigned 32-bit) of every whole text.

    A text of more than ``tokens`` ids is cut so that only its first piece is
    shorter. A text without ids (empty, no ``end_id``) gives no piece.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(doc, text):
        enc = rank_encoding(path, pattern, special)
        names = {name for name, _ in special}
        tail = [] if end_id is None else [end_id]
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids")}
        for d, t in zip(doc.to_pylist(), text.to_pylist()):
            t = t or ""
            ids = (enc.encode(t, allowed_special="all") if any(s in t for s in names) else enc.encode_ordinary(t)) + tail
            raw, n = array("I", ids).tobytes(), len(ids)
            begin, end, k = 0, (n % tokens or tokens) if n > tokens else n, 0
            while begin < n:
                for c, v in zip(out, (d, k, begin, end - begin, raw[4 * begin:4 * end])):
                    out[c].append(v)
                begin, end, k = end, end + tokens, k + 1
        return out

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                    f"doc_id {id_type}, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], cap: Capacity = Capacity()) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``length, first rank, end rank, first sequence, pieces a sequence, offset`` for a histogram of lengths.

    Raises ValueError if one piece alone breaks a constraint.
    """
    size = np.array([cap.tokens, cap.documents, cap.attention], float)
    weight = np.array(cap.weights, float)
    left = np.empty((0, 3))                # residual capacities of each group of alike sequences
    many = np.empty(0, np.int64)           # sequences in the group
    held: list[list[tuple[int, int]]] = []  # (length, pieces of it) in order of placing

    for length in sorted(counts, reverse=True):
        n, item = counts[length], np.array([length, 1, length * length], float)
        if (item > size).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while n:
            fits = np.flatnonzero((left >= item).all(1))
            if len(fits):
                if cap.rule == "norm":
                    score = -((weight * (left[fits] - item) / size) ** 2).sum(1)
                else:
                    score = (weight * left[fits] * item / size ** 2).sum(1)
                g = int(fits[np.argmax(score)])
            else:
                left, many = np.vstack([left, size]), np.append(many, np.int64(1 << 62))
                held.append([])
                g = len(held) - 1
            # under the norm a sequence that took a piece stays the best for the next one
            each = int(min(left[g] // item)) if cap.rule == "norm" else 1
            each = min(each, n)
            used = min(int(many[g]), n // each)
            if used < many[g]:   # the rest of the group stays as it is
                if held[g] or many[g] < 1 << 61:
                    left, many = np.vstack([left, left[g]]), np.append(many, many[g] - used)
                    held.append(list(held[g]))
                many[g] = used
            left[g] = left[g] - each * item
            held[g] = held[g] + [(length, each)]
            n -= used * each

    rows, rank, base = [], dict.fromkeys(counts, 0), 0
    for m, content in zip(many.tolist(), held):
        offset = 0
        for length, each in content:
            rows.append((length, rank[length], rank[length] + each * m, base, each, offset))
            rank[length] += each * m
            offset += length * each
        base += m
    return rows


def pack(pieces: DataFrame, cap: Capacity = Capacity(), key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (it has ``length``; ``key`` tells rows apart) with ``sequence_id`` and ``offset`` (long).

    ``pieces`` is read twice, so hand in a written table. A null or
    non-positive length raises. Columns of the input keep their names, so it
    must not have the two new ones.
    """
    if {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("the pieces already have sequence_id or offset")
    spark = pieces.sparkSession
    hist = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count("*")).collect()}   # at most cap.tokens rows fit
    if any(k is None or k <= 0 for k in hist):
        raise ValueError("lengths must be positive")
    rows = plan(hist, cap)
    if len(rows) > PLAN_ROWS:
        raise ValueError("the plan is not a small table")
    buckets = max(16, -(-sum(hist.values()) // BUCKET_ROWS))
    slots = spark.createDataFrame(rows, "_l long, _from long, _to long, _seq long, _each long, _offset long")

    dealt = pieces.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    before = (dealt.groupBy("length", "_b").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n"))
              .select(F.col("length").alias("_l2"), F.col("_b").alias("_b2"), "_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_b").orderBy(*key)) - 1
    ranked = (dealt.withColumn("_i", inside)
              .join(before, (F.col("length") == F.col("_l2")) & (F.col("_b") == F.col("_b2")))
              .withColumn("_rank", F.col("_before") + F.col("_i")))
    at = F.col("_rank") - F.col("_from")
    return (ranked.join(F.broadcast(slots), (F.col("length") == F.col("_l")) & (F.col("_rank") >= F.col("_from"))
                        & (F.col("_rank") < F.col("_to")))
            .select(*[F.col(c) for c in pieces.columns],
                    (F.col("_seq") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
                    (F.col("_offset") + F.pmod(at, F.col("_each")) * F.col("length")).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, path: str, pattern: str, special: tuple[tuple[str, int], ...] = (),
                   end_id: int | None = None, cap: Capacity = Capacity(), keep_ids: bool = False) -> DataFrame:
    """Cut and pack whole documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``ids_crc32`` is the unsigned CRC-32 of a piece's ids; with ``keep_ids``
    the ids themselves come along as ``ids`` (and are written to the shared
    folder between the two passes).
    """
    pieces = cut_pieces(docs, path, pattern, special, end_id, cap.tokens).withColumn("ids_crc32", F.crc32("ids"))
    return pack(shared(pieces if keep_ids else pieces.drop("ids")), cap, ("doc_id", "piece", "start", "ids_crc32"))
