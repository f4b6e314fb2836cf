"""The named queries of the corpus operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe, collocations, grid_join, langid, merkle, ngram_join, packing, pii, substring, token_counts, toxicity,
               url_filter)
from .common import shared

#: Url rules by host and path.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
             "com/de/": "block"}
#: The tokenizer files, the id that ends a document and the limit of a long one.
PACK_RANKS, PACK_SPECIAL, PACK_END = "byte_bpe_50k.tiktoken", (("<|endoftext|>", 50256),), 2
COUNT_FILE, TOKEN_LIMIT = "word_bpe_49k.json", 2048
CODEC_RANKS = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the score from which a document counts as toxic.
TOXIC_SCORE = 0.7


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_all(docs: DataFrame) -> DataFrame:
    """Sequences of at most 1024 tokens; the rank file holds the vocabulary of byte_bpe_50k.json."""
    return packing.pack_documents(docs, tokenizer_path(PACK_RANKS), pattern(), PACK_SPECIAL, PACK_END)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (pack_all(read(spark, sf_dir, "documents"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path(COUNT_FILE))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted on labelled documents that are not held out."""
    return langid.fit(langid.sample(docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES, default="allow")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(CODEC_RANKS)
    ids = bpe.encode(read(spark, sf_dir, "documents"), path, pattern())
    both = bpe.decode(ids, path, pattern()).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
    return bpe.id_digest(both, ["doc_id", "n_tokens", "decoded_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(read(spark, sf_dir, "embeddings"), 0.95)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))

    def count(kind: int) -> F.Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    counts = [count(k) for k in range(len(pii.KINDS))]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": text})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def toxicity_held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read(spark, sf_dir, "documents"), toxicity_held_out(F.col("doc_id"))
    train = toxicity.labelled(docs.where(~out), read(spark, sf_dir, "labels").where(~out))
    found = toxicity.score(docs, toxicity.fit(shared(train)))
    return found.select("doc_id", out.alias("held_out"), "score",
                        F.when(F.col("score") >= TOXIC_SCORE, 1).otherwise(0).alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1, "op2_cross_polytope_ann": op2, "op3_token_counts": op3, "op4_language_crf": op4,
    "op5_url_cascade": op5, "op6_chunked_bpe": op6, "op7_grid_order_join": op7, "op8_substring_dedup": op8,
    "op9_ngram_jaccard_join": op9, "op10_contextual_pii": op10,
    "op11_merkle_manifest": op11, "op12_phrase_collocations": op12, "op13_toxicity_nb": op13, "pipeline": pipeline,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"



def _leaf_sql(text: str) -> str:
    columns = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in columns) + ")"


#: crc32 of the decimal doc_id, by its definition.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
_RECEIVED = f"""(CASE WHEN {_CRC} % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END)"""

SQL: dict[str, str] = {
    "op5_url_cascade": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op7_grid_order_join": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN classes c USING (vec_id)""",
    "op8_substring_dedup": rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), owner AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM win JOIN owner USING (k), range(50) AS r(j) WHERE m < doc_id
), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p WHERE gone.p IS NULL GROUP BY words.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op9_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op11_merkle_manifest": rf"""
WITH RECURSIVE src AS (
  SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql(_RECEIVED)} AS received FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM src
), up AS (
  SELECT lang, 0 AS lvl, pos, leaf AS node, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 8
), subroots AS (
  SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, node, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM top WHERE n > 1 GROUP BY lvl, pos // 8
), height AS (SELECT lang, max(lvl) AS h FROM up GROUP BY lang),
runs AS (     -- levels of a language's tree, then those of the top tree, at the places of each subroot's path
  SELECT lang, lvl, pos // 8 AS run, list(node ORDER BY pos) AS slots FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 8
  UNION ALL
  SELECT s.lang, h + t.lvl, t.run, t.slots
  FROM subroots s JOIN height ON height.lang IS NOT DISTINCT FROM s.lang
  JOIN (SELECT lvl, pos // 8 AS run, list(node ORDER BY pos) AS slots FROM top WHERE n > 1 GROUP BY lvl, pos // 8) t
    ON t.run = s.pos >> (3 * t.lvl + 3)
), path AS (
  SELECT l.doc_id, l.lang, l.leaf, l.pos, r.lvl, r.slots,
         (CASE WHEN r.lvl < h THEN l.pos >> (3 * r.lvl) ELSE s.pos >> (3 * (r.lvl - h)) END) % 8 AS place
  FROM leaves l JOIN height ON height.lang IS NOT DISTINCT FROM l.lang JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN runs r ON r.lang IS NOT DISTINCT FROM l.lang
    AND r.run = CASE WHEN r.lvl < h THEN l.pos >> (3 * r.lvl + 3) ELSE s.pos >> (3 * (r.lvl - h) + 3) END
), proof AS (
  SELECT lang, pos, sha256(string_agg(array_to_string(slots[1:place], '') || array_to_string(slots[place + 2:8], ''), '' ORDER BY lvl)) AS p
  FROM path GROUP BY lang, pos
), fold AS (
  SELECT lang, pos, 0 AS lvl, received AS node FROM leaves
  UNION ALL
  SELECT f.lang, f.pos, f.lvl + 1,
         sha256(array_to_string(p.slots[1:p.place], '') || f.node || array_to_string(p.slots[p.place + 2:8], ''))
  FROM fold f JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.pos = f.pos AND p.lvl = f.lvl
), folded AS (SELECT lang, pos, arg_max(node, lvl) AS node FROM fold GROUP BY lang, pos)
SELECT l.doc_id, l.leaf, s.node AS subroot, t.node AS root, coalesce(proof.p, sha256('')) AS proof_sha256,
       folded.node AS folded_root, folded.node = t.node AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.n = 1
JOIN folded ON folded.lang IS NOT DISTINCT FROM l.lang AND folded.pos = l.pos
LEFT JOIN proof ON proof.lang IS NOT DISTINCT FROM l.lang AND proof.pos = l.pos""",
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, p FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), words AS (
  SELECT piece, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i
  FROM (SELECT piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces)
), runs AS (
  SELECT lang, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d
  FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)
), f AS (
  SELECT lang, [a] AS w, count(*) AS a FROM runs GROUP BY ALL
  UNION ALL SELECT lang, [a, b], count(*) FROM runs WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, [a, b, c], count(*) FROM runs WHERE c IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, [a, b, c, d], count(*) FROM runs WHERE d IS NOT NULL GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(w) = 1 GROUP BY lang),
f30 AS (SELECT * FROM f WHERE a >= 30),
c AS (SELECT lang, w, len(w) AS k, a FROM f30 WHERE len(w) > 1),
cuts AS (
  SELECT c.lang, c.w, x.a AS l, y.a AS r, cut, (CAST(c.a AS HUGEINT) * 2000000) // (x.a + y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f30 x ON x.lang = c.lang AND x.w = c.w[1:c.cut]
  JOIN f30 y ON y.lang = c.lang AND y.w = c.w[c.cut + 1:c.k]
), best AS (
  SELECT lang, w, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1
), held AS (
  SELECT lang, w[i:i + m - 1] AS w, max(a) AS held
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) AS r(m) WHERE m < k) GROUP BY ALL
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, encode(array_to_string(c.w, ' '))) AS rank,
       array_to_string(c.w, ' ') AS phrase, c.a, l, r, n, CAST(score AS BIGINT) AS score
FROM c JOIN best USING (lang, w) JOIN totals USING (lang) LEFT JOIN held USING (lang, w)
WHERE held IS NULL OR 100 * held < 80 * c.a
QUALIFY rank <= 2000""",
}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline
    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return SQL | extra
