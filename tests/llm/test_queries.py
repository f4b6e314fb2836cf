"""Registered queries against their SQL, and the pipeline stage by stage."""
import duckdb
import pytest

import corpus_pipeline as cp
from triagekit.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, duck, name):
    expected = duck.execute(queries.SQL[name]).df()
    cols = sorted(expected.columns)
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == cols
    a, b = (x[cols].astype(str).sort_values(cols).reset_index(drop=True) for x in (expected, got))
    assert a.equals(b)


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "12 34 !!", None, "s", 8), (10**6 + 1, None, "en", None, None),
                                   (10**6 + 2, docs.where("lang = 'en' and length(text) > 500").first().text, None, "s", 1),
                                   (10**6 + 3, "the and of mail me at someone@mail.example.org the of in", "en", "s", 1)], docs.schema)
    docs = docs.unionByName(extra).cache()
    kept = cp.language(spark, docs, SMALL).cache()
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 10**6 not in ids and 10**6 + 1 not in ids and {10**6 + 2, 10**6 + 3} <= ids
    assert kept.where("lang is null").count() == 0
    one = cp.near_duplicates(spark, kept, SMALL).cache()
    assert one.columns == docs.columns and 10**6 + 2 not in {r.doc_id for r in one.collect()}
    from triagekit.llm import ngram_join
    assert ngram_join.near_duplicates(one).where("doc_id <> component_id").count() == 0
    short = cp.repeats(spark, one, SMALL).cache()
    assert short.count() == one.count()
    from triagekit.llm import substring
    assert substring.remove_repeats(short).agg({"n_removed": "sum"}).first()[0] == 0
    clean = cp.personal_data(spark, short, SMALL).cache()
    assert clean.where("doc_id = 1000003").first().text == "the and of mail me at <EMAIL> the of in"
    packed = cp.pack(spark, clean, SMALL)
    assert packed.select("doc_id").distinct().count() == clean.count()


def test_run(spark):
    got = cp.run(spark, SMALL)
    assert got.count() > 0 and "sequence_id" in got.columns
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard", "substring_dedup", "pii", "packing"]


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SMALL)
        docs = out if out.columns == docs.columns else docs
    assert out.count() == 0
