"""Substring dedup, n-gram join and components against brute force."""
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from triagekit.llm import common, ngram_join, substring

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_classes(nodes, links):
    part = {x: x for x in nodes}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    links += [(500, i) for i in range(501, 540)] + [(None, 3), (4, 4)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    expected = brute_classes({x for e in real for x in e}, real)
    assert got == expected
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_the_word_pattern():
    text = "Ab  x y\tab c\x0b \x1cz Ä"
    h, start, end = common.word_hashes(text.encode())
    assert [text.encode()[a:b].decode() for a, b in zip(start, end)] == WORD.findall(text)
    low = common.word_hashes(text.encode(), lower=True)[0]
    assert low[0] == common.word_hashes(b"ab")[0][0] != h[0]
    assert len(common.word_hashes(b"")[0]) == 0 and len(common.window_hashes(h, 99)) == 0


def brute_removal(rows, window):
    owner, words = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, ws in words:
        if i is not None:
            for k in range(len(ws) - window + 1):
                key = tuple(ws[k:k + window])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, ws in words:
        gone = [False] * len(ws)
        for k in range(len(ws) - window + 1):
            if i is not None and owner[tuple(ws[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return sorted(out, key=lambda x: (x[0] is None, x))


def corpus(seed, n=60, passage=70):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 6)))
    shared = [[word() for _ in range(rng.randrange(30, passage))] for _ in range(6)]
    rows = []
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(0, len(ws) + 1)
            ws[at:at] = rng.choice(shared)
        rows.append((rng.randrange(1000) * 100 + i, rng.choice([" ", "\n", "  "]).join(ws)))
    rows += [(7_000_000 + i, rows[3][1]) for i in range(5)] + [(8_000_000, "la " * 400), (8_000_001, "la " * 180 + "x " + "la " * 90)]
    return rows + [(8_100_000, None), (8_100_001, ""), (None, rows[3][1]), (rows[5][0], rows[5][1])]


@pytest.mark.parametrize("hot, window, gram", [(10**9, 50, 20), (1, 12, 5)])
def test_substrings_equal_brute_force(documents, monkeypatch, hot, window, gram):
    monkeypatch.setattr(substring, "HOT_PASSAGES", hot)
    monkeypatch.setattr(substring, "SHARD_PASSAGES", 20)
    rows = corpus(1)
    got = substring.remove_repeats(documents(rows), window=window, gram=gram).collect()
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=lambda x: (x[0] is None, x))
    assert got == brute_removal(rows, window)
    assert sum(x[2] for x in got) > 500


def test_substrings_of_rows_that_share_an_id(documents):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(2, a), (2, b), (3, b), (1, a)]
    got = substring.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0), (2, 60), (3, 60)]
    assert substring.remove_repeats(documents([])).count() == 0


def brute_join(rows):
    sets = {}
    for i, t in rows:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append(frozenset(tuple(ws[k:k + 5]) for k in range(len(ws) - 4)) if len(ws) >= 5
                                      else frozenset([tuple(ws)] if ws else []))
    links = [(a, b) for a in sets for b in sets if a is not None and b is not None and a < b
             for x in sets[a] for y in sets[b] if x and 100 * len(x & y) >= 75 * len(x | y)]
    return sets, brute_classes([i for i in sets if i is not None], links), links


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    line = [word() for _ in range(25)]
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(3, 120))]
        if rng.random() < 0.5:
            base[0:0] = line
        for _ in range(rng.choice([1, 1, 2, 5, 9])):
            ws = list(base)
            for _ in range(rng.randrange(0, 6)):
                ws[rng.randrange(len(ws))] = word()
            rows.append((i * 7 % 1009, " ".join(ws)))
            i += 1
    return rows


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 3)])
def test_ngram_join_equals_brute_force(documents, seed, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "SUMMARY_LEAST", 2)
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", block)
    rows = near_copies(seed) + [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE two"), (2004, "One Two three"),
                                (None, "one two"), (2005, "x " * 300), (2006, "x " * 30)]
    rows.append(rows[0])
    got = ngram_join.near_duplicates(documents(rows)).collect()
    sets, part, links = brute_join(rows)
    assert len(links) > 20
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got)) == sorted(
        (i is None, i or 0, len(sets[i][0]), part[i] if i is not None else 0) for i, _ in rows)


def test_ngram_join_chain_without_a_common_hub(documents):
    """a-b and b-c link, a-c does not: the star rounds alone would not prove it."""
    w = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(w[12 * k:12 * k + 100])) for k in range(8)]
    got = ngram_join.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_join(rows)[1]
    assert ngram_join.near_duplicates(documents([])).count() == 0


def test_prefixes_of_similar_sets_meet_under_every_order():
    rng = np.random.default_rng(5)
    common_tokens = np.sort(rng.integers(0, 2**63, 50, dtype=np.uint64))
    rank = rng.integers(0, 4, 50)
    for _ in range(300):
        n = int(rng.integers(4, 60))
        a = np.unique(np.concatenate([rng.integers(0, 2**63, n, dtype=np.uint64), rng.choice(common_tokens, int(rng.integers(0, 40)))]))
        drop = int(len(a) * 0.25)
        b = np.sort(rng.choice(a, len(a) - drop, replace=False))
        if len(np.intersect1d(a, b)) * 4 >= len(np.union1d(a, b)) * 3:
            for seed in ngram_join.ORDERS:
                assert min(ngram_join.needed(len(a)), ngram_join.needed(len(b))) <= len(np.intersect1d(ngram_join.prefix(a, seed, common_tokens, rank), ngram_join.prefix(b, seed, common_tokens, rank)))


def test_automaton_matches_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        window, letters = rng.choice([2, 3, 5]), rng.choice([2, 3, 6])
        passages = [(d, np.array([rng.randrange(letters) for _ in range(rng.randrange(window, 14))], np.uint64))
                    for d in rng.sample(range(99), 6)]
        owner = defaultdict(lambda: 99)
        for d, w in passages:
            for i in range(len(w) - window + 1):
                owner[tuple(w[i:i + window])] = min(owner[tuple(w[i:i + window])], d)
        for (_, w), spans in zip(passages, substring.shard_owners(passages, window)):
            assert [o for _, n, o in spans for _ in range(n)] == [owner[tuple(w[i:i + window])] for i in range(len(w) - window + 1)]
