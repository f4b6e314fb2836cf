"""Merkle manifest, collocations and toxicity against plain Python."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagekit.llm import collocations, merkle, toxicity


# --- manifest ------------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def sides(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        out.append((run[:i % 8], run[i % 8 + 1:]))
        i //= 8
    return out


def expected(rows):
    """(id, leaf, subroot, root, proof, folded, verified) of rows (id, group, text), with text lower-cased for even ids."""
    made = [(i, g, h(field(i), field(g), field(t)),
             h(field(i), field(g), field(t if t is None or i is None or i % 2 else t.lower()))) for i, g, t in rows]
    groups = sorted({g for _, g, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, order = {}, {}
    for g in groups:
        own = sorted((r for r in made if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3]))
        order[g], trees[g] = own, climb([r[2] for r in own])
    top = climb([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for at, (i, _, leaf, other) in enumerate(order[g]):
            way = sides(trees[g], at) + sides(top, k)
            node = other
            for a, b in way:
                node = h(*a, node, *b)
            root = top[-1][0]
            out.append((i, leaf, trees[g][-1][0], root, h(*[x for a, b in way for x in a + b]), node, node == root))
    return sorted(out, key=str)


def rows_of(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("k", F.lit("clash")).repartition(partitions)
    text = F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text"))
    got = merkle.manifest(df, ["doc_id", "lang", "text"], {"text": text})
    return sorted([tuple(r)[:7] for r in got.collect()], key=str)


def test_manifest_equals_plain_trees(spark):
    rng = random.Random(5)
    rows = [(i * 37 - 9000, "en", f"Text {i}") for i in range(700)]                  # two rounds of blocks, negative ids
    rows += [(2**62 + i * 2**40, "de", "Ü" * i) for i in range(9)] + [(7, "fr", "one"), (8, None, "NULL group"), (9, None, None)]
    rows += [(None, "en", "no id"), (None, "en", "no id either"), (63, "zz", "a"), (127, "zz", "B"), (64, "zz", "")]
    rng.shuffle(rows)
    assert rows_of(spark, rows) == expected(rows)


def test_manifest_of_repeated_rows_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 4)
    rows = [(5, "en", "Same")] * 11 + [(5, "en", f"Other {i}") for i in range(5)] + [(6, "en", "x"), (4, "en", "y"), (68, "en", "Z")]
    rows += [(1, f"g{i:03}", "T") for i in range(75)]
    assert rows_of(spark, rows) == expected(rows)


def test_manifest_of_an_empty_table(spark):
    assert rows_of(spark, []) == []


def test_bitmap_ranks(spark):
    ids = sorted(random.Random(1).sample(range(-2**40, 2**40), 300) + list(range(100, 200)))
    maps = merkle.bitmaps(spark.createDataFrame([("=a", i) for i in ids], "k string, id long")).collect()
    assert sum(r.n for r in maps) == len(ids) and all(r.total == len(ids) and r.n == bin(r.bits & (2**64 - 1)).count("1") for r in maps)
    for r in maps:
        assert r.before == sum(i < (r.chunk << 16 | r.word << 6) for i in ids)


# --- collocations --------------------------------------------------------------------------

def phrases(rows, least, cover, top, longest=4):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            c = counts.setdefault(lang, Counter())
            c.update(tuple(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def texts(seed=3, n=60):
    rng = random.Random(seed)
    words = ["The", "cat", "säß", "on", "a", "mat", "x" * 80, "dog", "ran", "New", "york", "city"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choices(words, range(12, 0, -1))[0] + rng.choice([" "] * 6 + [", ", ".\n", "\t", " "])
                                                     for _ in range(rng.randint(0, 200)))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), ("en", ".,;"), ("zz", "only rare words here")] + [("en", "new york city hall")] * 9


@pytest.mark.parametrize("tiers", [(1 << 16, 1 << 18), (4, 3)])
def test_phrases_equal_plain_counts(spark, monkeypatch, tiers):
    """With small tiers most units are counted in lists, by key."""
    monkeypatch.setattr(collocations, "WORD_TIER", tiers[0])
    monkeypatch.setattr(collocations, "UNIT_TIER", tiers[1])
    rows = texts()
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("key", F.lit(1)).repartition(3)
    got = collocations.mine(df, least=5, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases(rows, 5, 80, 40)


def test_tiles_count_dense_and_sparse_pairs(monkeypatch):
    monkeypatch.setattr(collocations, "DENSE", 50)
    monkeypatch.setattr(collocations, "MOST_DENSE", 2)
    monkeypatch.setattr(collocations, "HELD", 300)
    rng = np.random.default_rng(2)
    unit, word = np.minimum(rng.zipf(1.3, 20000), 200000), np.minimum(rng.zipf(1.3, 20000), 65535)
    tiles, got = collocations.Tiles(), Counter()
    for part in np.array_split(np.arange(20000), 20):
        tiles.add(unit[part], word[part])
        tiles.settle()
        for u, v, n in zip(*tiles.take(False)):
            got[int(u), int(v)] += int(n)
    assert 0 < len(tiles.dense) <= 2
    for u, v, n in zip(*tiles.take(True)):
        got[int(u), int(v)] += int(n)
    assert got == Counter(zip(unit.tolist(), word.tolist()))


def test_scores_beyond_64_bits(spark):
    big = 2**61 - 1
    row = spark.createDataFrame([(big, big, big + 5)], "a long, l long, r long")
    both = row.withColumn("both", collocations._exact(F.col("l")) + collocations._exact(F.col("r")))
    assert both.select(F.expr("(cast(a as decimal(20,0)) * 2000000bd) div both")).first()[0] == 2000000 * big // (2 * big + 5)


def test_phrases_of_an_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).collect() == []


# --- toxicity ------------------------------------------------------------------------------

def corpus(seed, n):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 120))
        bad = i % 7 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["Wretch", "numbskull", "vermin"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1, 600)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "vermin"), (9000, None), (9001, ""), (9002, "a " * 400000 + "vermin wretch vermin")],
                                 "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 != 1] + [(3, None), (None, 1), (10**9, 1)], "doc_id long, toxic int")
    from triagekit.llm.common import shared
    model = toxicity.fit(shared(toxicity.labelled(docs.where("doc_id % 3 <> 1"), labels)))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.7, y) for i, _, y in rows if i % 3 == 1]
    assert np.mean([p for p, y in held if y]) > 0.9 and np.mean([p for p, y in held if not y]) < 0.02
    assert got[9000] == got[9001]


def test_long_texts_are_hashed_whole(monkeypatch):
    text = "".join(random.Random(4).choices("abcdefé ", k=5000))
    one, held = np.zeros(toxicity.BUCKETS, bool), np.zeros(toxicity.BUCKETS, bool)
    toxicity.mark(text, one)
    monkeypatch.setattr(toxicity, "STRETCH", 97)
    toxicity.mark(text, held)
    assert (one == held).all() and one.any()


def test_scales_follow_the_counts():
    scale, size = toxicity.scales([(-1, 8, 4), (5, 2, 3), (9, 4, 0)])
    assert size == (8, 4)
    assert scale[5] == pytest.approx(np.log((4 / 6) / (3 / 10))) and scale[9] == pytest.approx(np.log((1 / 6) / (5 / 10)))
    assert scale[0] == 0


def test_one_class_or_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    from triagekit.llm.common import shared
    for labels in ([(1, 1)], []):
        known = spark.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.fit(shared(toxicity.labelled(docs, known)))
        assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5, 0.5]
    empty = docs.where("doc_id < 0")
    assert toxicity.score(empty, model).count() == 0


def test_descent_finds_the_minimum():
    a = np.diag([1.0, 10.0, 100.0])
    x = toxicity.descend(lambda x: (float((x - 1) @ a @ (x - 1)) / 2, a @ (x - 1)), np.zeros(3), 50)
    assert np.allclose(x, 1, atol=1e-3)
