"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams (``ORDERS`` characters) that it holds,
each counted once. A feature's scale is the log of the ratio of its smoothed
shares among the documents of the two classes; the counts behind it come from
all labelled rows (one pass, partial counts by task, at most ``BUCKETS`` rows
reach the driver). A logistic regression on the scaled features, fitted on about
``FIT_DOCS`` rows a class chosen by hash, gives each feature its weight; both
classes weigh the same in the fit. Its rows stay in tasks: each of at most
``ROUNDS`` limited-memory quasi-Newton steps asks Spark for the loss and the
gradient (``BUCKETS`` numbers a task, at most ``PARTS`` tasks), which keeps the
frequent features ahead, as a solver that standardises the columns would not.
Scoring is one pass over whole texts with the weights (scale times coefficient)
broadcast.

Nulls: a null text is empty and has the score of the intercept. Rows with a null
label or without a partner do not train; a document with several labels trains
with each. Without both classes the score is 0.5 everywhere. Rows with a null id
and repeated rows each give a result row. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, map_rows, may_hold, shared

ORDERS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
FIT_DOCS = 4000          # rows of a class in the regression, about
SMOOTHING = 1.0
REG = 0.01
ROUNDS = 25
PARTS = 12               # tasks that hold the rows of the regression
#: Characters hashed at once; a longer text is hashed in stretches that overlap by the longest n-gram.
STRETCH = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray     # of each bucket: scale times coefficient
    intercept: float


def mark(text: str | None, held: np.ndarray) -> None:
    """Set ``held`` (bool, by bucket) at the n-grams of the lower-cased text between two blanks."""
    text = f" {(text or '').lower()} "
    longest = max(ORDERS)
    for begin in range(0, len(text), STRETCH):
        part = text[begin:begin + STRETCH + longest - 1]
        char = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        code = char
        for n in range(2, longest + 1):
            if len(char) < n:
                break
            code = (code[:-1] * _ODD) ^ (char[n - 1:] + np.uint64(n))
            if n in ORDERS:
                held[(code * _ODD) >> np.uint64(64 - BITS)] = True


def buckets_of(text: str | None, held: np.ndarray) -> np.ndarray:
    """Sorted buckets of a text; ``held`` is cleared before and after."""
    mark(text, held)
    at = np.flatnonzero(held)
    held[at] = False
    return at


def labelled(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``label, text, pick`` of documents with a label 0 or 1; texts without one are mostly left out before the join."""
    known = shared(labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
                   .select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).distinct())
    may = may_hold(known, "doc_id")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(may(F.col("doc_id")))
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return src.join(known, "doc_id").select("label", "text", unit.alias("pick"))


def counts(train: DataFrame) -> DataFrame:
    """``bucket, n0, n1``: documents of each class that hold the bucket, and bucket -1: all documents."""
    schema = "bucket int, n0 long, n1 long"
    target = _arrow_schema(train.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros((2, BUCKETS + 1), np.int64), np.zeros(BUCKETS, bool)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[label, buckets_of(text.as_py(), held)] += 1
                total[label, BUCKETS] += 1
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == BUCKETS, -1, at), pa.int32()),
                                          pa.array(total[0, at]), pa.array(total[1, at])], schema=target)

    return (train.select("label", "text").mapInArrow(run, schema)
            .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def scales(found: list[tuple[int, int, int]]) -> tuple[np.ndarray, tuple[int, int]]:
    """Log-count ratio of every bucket, and the number of documents of each class."""
    n = np.zeros((2, BUCKETS + 1))
    for bucket, n0, n1 in found:
        n[:, bucket] = n0, n1          # -1 is the last place
    share = (n[:, :-1] + SMOOTHING) / (n[:, -1:] + 2 * SMOOTHING)
    seen = n[:, :-1].any(0)
    return np.where(seen, np.log(share[1] / share[0]), 0.0), (int(n[0, -1]), int(n[1, -1]))


def descend(value, start: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Minimise a smooth function by limited-memory BFGS; ``value(x)`` gives (value, gradient)."""
    x, steps = start, []
    f, g = value(x)
    for _ in range(rounds):
        direction, weights = -g, []
        for dx, dg in reversed(steps):
            w = (dx @ direction) / (dx @ dg)
            weights.append(w)
            direction = direction - w * dg
        if steps:
            dx, dg = steps[-1]
            direction = direction * ((dx @ dg) / (dg @ dg))
        for (dx, dg), w in zip(steps, reversed(weights)):
            direction = direction + (w - (dg @ direction) / (dx @ dg)) * dx
        slope = g @ direction
        size = 1.0 if steps else 1.0 / max(1.0, float(np.linalg.norm(g)))
        if slope >= 0:
            break
        for _ in range(20):
            f2, g2 = value(x + size * direction)
            if f2 <= f + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        dx, dg = size * direction, g2 - g
        if dx @ dg > 1e-12:
            steps = [*steps, (dx, dg)][-memory:]
        x, done, f, g = x + dx, abs(f - f2) <= 1e-7 * abs(f), f2, g2
        if done:
            break
    return x


def fit(train: DataFrame) -> Model:
    """The classifier of rows ``label, text, pick`` (a written table: it is read twice)."""
    spark = train.sparkSession
    scale, size = scales([tuple(r) for r in counts(train).collect()])     # at most BUCKETS + 1 rows
    if not all(size):
        return Model(np.zeros(BUCKETS), 0.0)
    share = F.when(F.col("label") == 1, F.lit(FIT_DOCS / size[1])).otherwise(F.lit(FIT_DOCS / size[0]))

    def sets(label, text):
        held = np.zeros(BUCKETS, bool)
        return {"label": label, "at": [buckets_of(t.as_py(), held).astype(np.int32) for t in text]}

    rows = map_rows(train.where(F.col("pick") < share).select("label", "text"), sets, "label int, at array<int>")
    rows = shared(rows.repartition(PARTS))
    many = {r[0]: r[1] for r in rows.groupBy("label").agg(F.count("*")).collect()}
    if len(many) < 2:
        return Model(np.zeros(BUCKETS), 0.0)
    weight = np.array([0.5 / many[0], 0.5 / many[1]])
    schema = "loss double, slope double, gradient binary"
    target = _arrow_schema(spark, schema)

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast((scale * x[:-1], float(x[-1])))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, b = sent.value
            gradient, loss, slope = np.zeros(BUCKETS), 0.0, 0.0
            for batch in batches:
                label, sets = batch.column(0).to_numpy(), batch.column(1)
                at, n = sets.flatten().to_numpy(), np.diff(sets.offsets.to_numpy())
                of = np.repeat(np.arange(len(n)), n)
                z = np.bincount(of, w[at], len(n)) + b
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                loss += float((weight[label] * (np.logaddexp(0, z) - label * z)).sum())
                error = weight[label] * (p - label)
                gradient += np.bincount(at, error[of], BUCKETS)
                slope += float(error.sum())
            yield pa.RecordBatch.from_pydict({"loss": [loss], "slope": [slope],
                                              "gradient": [gradient.tobytes()]}, schema=target)

        got = rows.mapInArrow(part, schema).toArrow().to_pylist()          # PARTS rows of BUCKETS numbers
        sent.destroy()
        gradient = scale * sum(np.frombuffer(r["gradient"]) for r in got) + REG * x[:-1]
        return (sum(r["loss"] for r in got) + REG / 2 * float(x[:-1] @ x[:-1]),
                np.append(gradient, sum(r["slope"] for r in got)))

    x = descend(value, np.zeros(BUCKETS + 1), ROUNDS)
    return Model(scale * x[:-1], float(x[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, score`` (0 to 1) and the columns ``keep``."""
    keep = keep or {}
    sent = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[c.alias(n) for n, c in keep.items()])
    types, names = dict(src.dtypes), list(keep)

    def run(doc, text, *rest):
        m, held, out = sent.value, np.zeros(BUCKETS, bool), []
        for t in text:
            at = buckets_of(t.as_py(), held)
            out.append(m.weights[at].sum() + m.intercept)
        x = np.clip(np.array(out), -700, 700)
        return {"doc_id": doc, "score": 1 / (1 + np.exp(-x))} | dict(zip(names, rest))

    return map_rows(src, run, f"doc_id {types['doc_id']}, score double" + "".join(f", {c} {types[c]}" for c in names))
