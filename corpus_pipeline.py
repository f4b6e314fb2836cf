"""From raw documents to packed token sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared checkpoint folder and hands the reread table
to the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagekit.llm import langid, ngram_join, pii, queries, substring
from triagekit.llm.common import remove
from triagekit.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose best language has a lower mean posterior is rejected, as is one without a letter.
LEAST_LANGUAGE_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language; a missing ``lang`` is filled in."""
    model = queries.language_model(docs)
    found = langid.predict(docs, model, keep={f"_{c}": F.col(c) for c in COLUMNS if c != "doc_id"})
    kept = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select("doc_id", F.col("_text").alias("text"), F.coalesce("_lang", "lang_pred").alias("lang"),
                       F.col("_source").alias("source"), F.col("_n_chars").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group; of rows that repeat an id, one. Rows without an id stay."""
    from triagekit.llm.common import shared
    found = shared(ngram_join.near_duplicates(docs).select("doc_id", "component_id"))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        order = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*COLUMNS[1:])))
        kept = (kept.where("doc_id is not null").withColumn("_i", order).where("_i = 1").drop("_i")
                .unionByName(kept.where("doc_id is null")))
    return kept.select(*COLUMNS)


def _with_text(df: DataFrame) -> DataFrame:
    """The columns of documents with the character count of the new text."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that a document with a smaller id has; other texts stay as they are."""
    named = docs.select("doc_id", "text", "lang", "source", F.col("text").alias("_text"))
    done = substring.remove_repeats(named, keep=("lang", "source", "_text"))
    return _with_text(done.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_text"))))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    return _with_text(pii.redact(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return queries.pack_all(docs)


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("substring_dedup", repeats),
          ("pii", personal_data), ("packing", pack)]

#: The language model and the tokenizer are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        remove(spark)
    return docs
