"""Feature building (I1-I6): TF-IDF, one-hot, standard scaling, assembled preprocessor.

Fitting produces small metadata (vocabulary <= max_features terms, category
lists, per-column moments), computed by distributed aggregates on the training
rows only. Transforming is a narrow projection: words are counted in vectorised
UDFs, one-hot and scaling are column expressions, and ``VectorAssembler`` emits
compressed (sparse) vectors.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import NGram, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as TX
from ..session import persist_shared

# Tokens of two or more word characters (Unicode letters, digits, underscore).
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


@dataclass
class TfidfSpec:
    max_features: int | None = C.TFIDF_MAX_FEATURES
    ngram_max: int = 2
    min_df: int = C.TFIDF_MIN_DF
    max_df: float = C.TFIDF_MAX_DF
    sublinear_tf: bool = True
    strip_accents: bool = True
    lowercase: bool = True


def with_terms(df: DataFrame, text_col: str, spec: TfidfSpec, out: str = "_terms") -> DataFrame:
    """Analyzer: lower-case, optional accent folding, word tokens, optional bigrams.

    The folded text and the unigram array are projected as columns first, so
    the (vectorised) accent-folding UDF never sits inside a lambda.
    """
    x = F.lower(F.col(text_col)) if spec.lowercase else F.col(text_col)
    if spec.strip_accents:
        x = TX.strip_accents(x)
    d = df.withColumn("_norm", x).withColumn("_tok", F.regexp_extract_all(F.col("_norm"), F.lit(TERM_PATTERN), 0))
    if spec.ngram_max < 2:
        return d.withColumn(out, F.col("_tok")).drop("_norm", "_tok")
    # adjacent pairs joined by a space, built by the JVM NGram transformer (no per-element lambdas)
    d = NGram(n=2, inputCol="_tok", outputCol="_bi").transform(d.withColumn("_tok", F.coalesce("_tok", F.array().cast("array<string>"))))
    t = F.when(F.col("_norm").isNull(), F.lit(None).cast("array<string>")).otherwise(F.concat("_tok", "_bi"))
    return d.withColumn(out, t).drop("_norm", "_tok", "_bi")


# Words a task counts before it hands the counts on, and pairs likewise.
HELD_WORDS, HELD_PAIRS = 300_000, 2_000_000
# Words whose pairs are counted by place; with more of them, pairs are counted as rows.
MOST_LEADS = 20_000
# First rows whose leading words are a guess at those; a wrong guess costs a second pass.
GUESS_ROWS = 1000


@lru_cache(maxsize=1)
def _marks() -> np.ndarray:
    """For every code point, whether it is a combining mark (``\\p{M}``)."""
    return np.array([unicodedata.category(chr(c))[0] == "M" for c in range(sys.maxunicode + 1)])


def _folded(text: str) -> str:
    """NFKD without combining marks."""
    points = np.frombuffer(unicodedata.normalize("NFKD", text).encode("utf-32-le"), np.uint32)
    return points[~_marks()[points]].tobytes().decode("utf-32-le")


def _analyser(spec: TfidfSpec) -> Callable[[str | None], list[str]]:
    """The words of a text as ``with_terms`` finds them, for counting inside tasks (Python's ``\\w`` is the class of TERM_PATTERN)."""
    find = re.compile(r"\w{2,}").findall

    def words(text: str | None) -> list[str]:
        if not text:
            return []
        x = text.lower() if spec.lowercase else text
        if spec.strip_accents and not x.isascii():
            x = _folded(x)
        return find(x)

    return words


def _counts(df: DataFrame, text_col: str, spec: TfidfSpec, leads: list[str]) -> DataFrame:
    """``term, df, tf`` of single words and of adjacent pairs of ``leads``; tasks count before the shuffle."""
    words, m = _analyser(spec), len(leads)

    def batch(term: list[str], docs, tf) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"term": pa.array(term, pa.string()), "df": pa.array(docs, pa.int64()),
                                           "tf": pa.array(tf, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(leads)}
        tf, docs, held, n = Counter(), Counter(), [], 0

        def singles():
            return batch(list(docs), list(docs.values()), [tf[t] for t in docs])

        def pairs():
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            many = np.bincount(at, np.concatenate([c for _, c in held]), len(key)).astype(np.int64)
            return batch([f"{leads[k // m]} {leads[k % m]}" for k in key.tolist()], np.bincount(at, minlength=len(key)).astype(np.int64), many)

        for b in batches:
            for text in b.column(0):
                w = words(text.as_py())
                tf.update(w)
                docs.update(set(w))
                if m:
                    at = np.fromiter((place.get(x, -1) for x in w), np.int64, len(w))
                    both = (at[:-1] >= 0) & (at[1:] >= 0)
                    held.append(np.unique((at[:-1] * m + at[1:])[both], return_counts=True))
                    n += len(held[-1][0])
            if len(docs) > HELD_WORDS:
                yield singles()
                tf.clear()
                docs.clear()
            if n > HELD_PAIRS:
                yield pairs()
                held, n = [], 0
        yield singles()
        if held:
            yield pairs()

    parts = df.select(text_col).mapInArrow(run, "term string, df long, tf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _term_counts(df: DataFrame, text_col: str, spec: TfidfSpec) -> DataFrame:
    """``term, df, tf`` of all words and pairs, as rows."""
    docs = with_terms(df.select(text_col), text_col, spec, "t").select("t")
    # one explode of every token (tf) followed by the document's distinct terms (df); the position
    # tells which part an element came from. One grouped aggregation: map-side combining shuffles
    # per-partition distinct terms, not every token
    ex = docs.select(F.size("t").alias("_n"), F.posexplode(F.concat("t", F.array_distinct("t"))).alias("_i", "term"))
    is_tf = (F.col("_i") < F.col("_n")).cast("long")
    return ex.groupBy("term").agg(F.sum(1 - is_tf).alias("df"), F.sum(is_tf).alias("tf"))


def tfidf_vocabulary(df: DataFrame, text_col: str, spec: TfidfSpec = TfidfSpec(), id_col: str | None = None) -> DataFrame:
    """Vocabulary table: term, df, tf, idf, index.

    Document frequency filters first (df >= min_df, df <= max_df * n_docs),
    then the ``max_features`` most frequent terms (ties by term); indices
    follow term order. Smooth idf: ln((1+n)/(1+df)) + 1.

    A pair occurs no more often than either of its words, in no more documents.
    So with ``max_features`` only pairs of words that reach the last place and
    ``min_df`` can enter. One pass counts all words, and the pairs of words that
    lead in the first rows; if others reach it too, a second pass counts the
    pairs of all that do.
    """
    n_docs = df.count()
    max_doc = spec.max_df * n_docs if isinstance(spec.max_df, float) else spec.max_df

    def kept(stats: DataFrame) -> DataFrame:
        return stats.filter((F.col("df") >= spec.min_df) & (F.col("df") <= F.lit(max_doc)))

    def first(stats: DataFrame) -> DataFrame:
        return kept(stats).orderBy(F.col("tf").desc(), F.col("term")).limit(spec.max_features).select("term", "df", "tf")

    if not spec.max_features:
        return _indexed(kept(_term_counts(df, text_col, spec)), n_docs)
    guess = []
    if spec.ngram_max >= 2:
        few = _counts(df.select(text_col).limit(GUESS_ROWS), text_col, spec, [])
        guess = sorted(r["term"] for r in few.orderBy(F.desc("tf"), "term").limit(2 * spec.max_features).collect())
    counts = persist_shared(_counts(df, text_col, spec, guess))
    words = counts.filter(~F.col("term").contains(" "))
    top = first(words).collect()        # at most max_features rows
    if spec.ngram_max >= 2:
        least = top[-1]["tf"] if len(top) == spec.max_features else 0
        reach = words.filter((F.col("tf") >= least) & (F.col("df") >= spec.min_df)).select("term")
        leads = [r["term"] for r in reach.limit(MOST_LEADS + 1).collect()]
        if len(leads) > MOST_LEADS:
            top = first(_term_counts(df, text_col, spec)).collect()
        elif set(leads) <= set(guess):
            top = first(counts).collect()
        else:
            top = first(_counts(df, text_col, spec, sorted(leads))).collect()
    counts.unpersist()
    return _indexed(df.sparkSession.createDataFrame(top, "term string, df long, tf long"), n_docs)


def _indexed(kept: DataFrame, n_docs: int) -> DataFrame:
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    v = kept.select("term", "df", "tf", idf.alias("idf"))
    return v.withColumn("index", (F.row_number().over(_term_window()) - 1).cast("int"))


def _term_window():
    from pyspark.sql import Window
    # the vocabulary has at most max_features rows
    return Window.orderBy("term")


@dataclass
class TfidfModel:
    spec: TfidfSpec
    vocab: list[str]
    idf: list[float]

    @classmethod
    def fit(cls, df: DataFrame, text_col: str, spec: TfidfSpec = TfidfSpec()) -> "TfidfModel":
        rows = tfidf_vocabulary(df, text_col, spec).orderBy("index").collect()  # <= max_features rows
        return cls(spec, [r["term"] for r in rows], [float(r["idf"]) for r in rows])

    def transform(self, df: DataFrame, text_col: str, out_col: str = "tfidf") -> DataFrame:
        if not self.vocab:
            return df.withColumn(out_col, array_to_vector(F.array().cast("array<double>")))
        weigh = self.weigher()

        @F.pandas_udf("array<double>")
        def weights(texts: pd.Series) -> pd.Series:
            return pd.Series([weigh(t) for t in texts], dtype=object)

        return df.withColumn(out_col, array_to_vector(weights(text_col)))

    def weigher(self) -> Callable[[str | None], np.ndarray]:
        """Weights of a text, one a term of the vocabulary: sublinear tf x idf, L2 (zeros without terms)."""
        spec, size, idf, words = self.spec, len(self.vocab), np.array(self.idf), _analyser(self.spec)
        parts = [t.split(" ") for t in self.vocab]
        place = {w: i for i, w in enumerate(sorted({w for p in parts for w in p}))}
        m = len(place)
        single = np.full(m + 1, size)       # the last place is a word's that no term has
        for i, p in enumerate(parts):
            if len(p) == 1:
                single[place[p[0]]] = i
        pairs = sorted((place[p[0]] * (m + 1) + place[p[1]], i) for i, p in enumerate(parts) if len(p) == 2)
        keys, at = (np.array([p[j] for p in pairs] + [[np.iinfo(np.int64).max, size][j]], np.int64) for j in (0, 1))

        def weigh(text: str | None) -> np.ndarray:
            w = words(text)
            ids = np.fromiter((place.get(x, m) for x in w), np.int64, len(w))
            pair = ids[:-1] * (m + 1) + ids[1:]
            hit = np.searchsorted(keys, pair)
            found = np.concatenate([single[ids], np.where(keys[hit] == pair, at[hit], size)])
            x = np.bincount(found, minlength=size + 1)[:size].astype(float)
            if spec.sublinear_tf:
                x = np.where(x > 0, 1.0 + np.log(np.maximum(x, 1.0)), 0.0)
            x *= idf
            norm = np.sqrt(np.add.accumulate(x * x)[-1])     # in order, as ``Normalizer`` sums
            return x / norm if norm > 0 else x

        return weigh

    def feature_names(self) -> list[str]:
        return self.vocab


def tfidf_long(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, spec: TfidfSpec = TfidfSpec()) -> DataFrame:
    """(id, term, weight) for present terms: sublinear tf x idf, L2 per row (relational form of I1).

    Per-row term counts are made inside the tasks (no token shuffle), and only
    terms that a row has become rows; the vocabulary (at most max_features
    terms) is read once on the driver.
    """
    rows = vocab.orderBy("index").collect()
    model = TfidfModel(spec, [r["term"] for r in rows], [float(r["idf"]) for r in rows])
    weigh = model.weigher()

    @F.pandas_udf("index array<int>, weight array<double>")
    def present(texts: pd.Series) -> pd.DataFrame:
        found = [weigh(t) for t in texts]
        at = [np.flatnonzero(x).astype(np.int32) for x in found]
        return pd.DataFrame({"index": pd.Series(at, dtype=object), "weight": pd.Series([x[i] for x, i in zip(found, at)], dtype=object)})

    x = df.select(id_col, present(text_col).alias("_v")).select(
        id_col, F.inline(F.arrays_zip("_v.index", "_v.weight")).alias("index", "weight"))
    names = df.sparkSession.createDataFrame([(i, t) for i, t in enumerate(model.vocab)], "index int, term string")
    # bounded by max_features
    j = x.join(F.broadcast(names) if spec.max_features else names, "index")
    return j.select(id_col, "term", "weight")


# ----------------------------------------------------------------------------------- one-hot / scaling

@dataclass
class OneHotModel:
    """Sorted categories per column from the training rows; first dropped, unseen -> all zero."""
    categories: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str]) -> "OneHotModel":
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
        rows = long.filter(F.col("value").isNotNull()).distinct().collect()  # bounded by category counts
        cats: dict[str, list[str]] = {c: [] for c in cols}
        for r in rows:
            cats[r["column"]].append(r["value"])
        return cls({c: sorted(v) for c, v in cats.items()})

    def columns(self):
        out = []
        for c, vals in self.categories.items():
            for v in vals[1:]:
                out.append((f"{c}_{v}", F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))))
        return out

    def feature_names(self) -> list[str]:
        return [n for n, _ in self.columns()]


@dataclass
class ScalerModel:
    """Training mean and population std per column; zero std scales by 1 (I4)."""
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str]) -> "ScalerModel":
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
        r = df.agg(*aggs).first()
        return cls({c: float(r[f"m_{c}"] or 0.0) for c in cols},
                   {c: float(r[f"s_{c}"] or 0.0) for c in cols})

    def columns(self):
        out = []
        for c, m in self.means.items():
            s = self.stds[c]
            s = s if s > 0 else 1.0
            out.append((c, (F.col(c).cast("double") - F.lit(m)) / F.lit(s)))
        return out

    def feature_names(self) -> list[str]:
        return list(self.means)


@dataclass
class Preprocessor:
    """Column transformer with named blocks text__, cat__, num__.

    ``fit`` on the training rows only (``fit_scope='all'`` is the caller's
    choice of rows, I6).
    """
    text_col: str | None = C.TEXT_COL_CLEAN
    cat_cols: list[str] = field(default_factory=lambda: list(C.CATEGORICAL_COLS))
    num_cols: list[str] = field(default_factory=lambda: list(C.NUMERIC_COLS))
    spec: TfidfSpec = field(default_factory=TfidfSpec)
    tfidf: TfidfModel | None = None
    onehot: OneHotModel | None = None
    scaler: ScalerModel | None = None

    def fit(self, df: DataFrame) -> "Preprocessor":
        p = Preprocessor(self.text_col, list(self.cat_cols), list(self.num_cols), self.spec)
        if self.text_col:
            p.tfidf = TfidfModel.fit(df, self.text_col, self.spec)
        if self.cat_cols:
            p.onehot = OneHotModel.fit(df, self.cat_cols)
        if self.num_cols:
            p.scaler = ScalerModel.fit(df, self.num_cols)
        return p

    def transform(self, df: DataFrame, out_col: str = "features") -> DataFrame:
        x = df
        inputs = []
        if self.tfidf is not None:
            x = self.tfidf.transform(x, self.text_col, "_tfidf")
            inputs.append("_tfidf")
        extra = []
        if self.onehot is not None:
            extra += [(f"_cat_{i}", e) for i, (_, e) in enumerate(self.onehot.columns())]
        if self.scaler is not None:
            extra += [(f"_num_{i}", e) for i, (_, e) in enumerate(self.scaler.columns())]
        if extra:
            x = x.select("*", *[e.alias(n) for n, e in extra])
            inputs += [n for n, _ in extra]
        va = VectorAssembler(inputCols=inputs, outputCol=out_col)
        return va.transform(x).drop(*inputs)

    def feature_names(self) -> list[str]:
        names = []
        if self.tfidf is not None:
            names += [f"text__{t}" for t in self.tfidf.feature_names()]
        if self.onehot is not None:
            names += [f"cat__{n}" for n in self.onehot.feature_names()]
        if self.scaler is not None:
            names += [f"num__{n}" for n in self.scaler.feature_names()]
        return names


def normalized_text(df: DataFrame, text_col: str, out: str, spec: TfidfSpec = TfidfSpec()) -> DataFrame:
    """The analyzer's normalisation (lower-case, accent folding) as a column, computed once.

    Analyse it afterwards with ``pre_normalized(spec)``: identical terms, no repeated folding.
    """
    x = F.lower(F.col(text_col)) if spec.lowercase else F.col(text_col)
    return df.withColumn(out, TX.strip_accents(x) if spec.strip_accents else x)


def pre_normalized(spec: TfidfSpec) -> TfidfSpec:
    return TfidfSpec(spec.max_features, spec.ngram_max, spec.min_df, spec.max_df, spec.sublinear_tf, False, False)
