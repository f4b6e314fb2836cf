"""Nearest neighbours and the grid join against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagekit.llm import ann, grid_join

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("dim", T.StringType()), T.StructField("v", T.StringType())])


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    return make


def clustered(n, d, seed, groups=20, noise=0.25):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, d))
    return (centers[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, d))).astype("f4")


def cosines(x):
    x = x.astype("f8")
    x = x / np.linalg.norm(x, axis=1)[:, None]
    return x @ x.T


BAD = [(9001, None), (9002, [0.0] * 8), (9003, [1.0, None] + [0.0] * 6), (9004, [float("nan")] * 8),
       (9005, [float("inf")] + [0.0] * 7), (9006, []), (None, [1.0] * 8)]


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 12))
    assert np.allclose(np.linalg.norm(ann.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
    turned = ann.rotate(x, 3)
    best = ann.axes(turned, 3)
    assert (best[:, 0] == ann.axes(turned, 1)[:, 0]).all()
    assert best.shape == (5, 3) and (np.abs(turned).argmax(1) == best[:, 0] // 2).all()


def test_search_finds_nine_of_ten(vectors):
    x = clustered(1500, 32, 2, groups=300, noise=0.6)
    got = ann.search(vectors([(i, v.tolist()) for i, v in enumerate(x)] + [(None, [1.0] * 32), (9000, None)]),
                     F.col("vec_id") % 25 == 0).collect()
    s = cosines(x)
    np.fill_diagonal(s, -2)
    hits, n = 0, 0
    for q in range(0, 1500, 25):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and len({r.vec_id for r in mine}) == 5
        assert np.allclose([r.score for r in mine], [s[q, r.vec_id] for r in mine], atol=1e-12)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.argsort(-s[q])[:5].tolist()))
        n += 5
    assert hits / n >= 0.9


def test_search_small_tables_ties_and_bad_vectors(vectors):
    rows = [(0, [1.0] + [0.0] * 7)] + [(i, [0.0, 1.0] + [0.0] * 6) for i in (3, 2, 7, 7)] + BAD
    got = ann.search(vectors(rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(1, 2, 0.0), (2, 3, 0.0), (3, 7, 0.0)]
    assert ann.search(vectors([]), F.col("vec_id") == 0).count() == 0
    assert ann.search(vectors([(0, [1.0])]), F.col("vec_id") == 0).count() == 0


def test_search_splits_a_hot_bucket(vectors, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(120)] + [(i, [1.0, 0.001 * i, 0.0, 0.0]) for i in range(120, 160)]
    got = ann.search(vectors(rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(r.vec_id for r in got if r.query_id == 50) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("several", [False, True])   # copies of one row, or several vectors of one id
@pytest.mark.parametrize("sign", [1.0, -1.0])        # found in the query's bucket, or only by the comparison with all rows
def test_search_counts_ids_and_not_rows(vectors, sign, several):
    near = [(1, [sign, 0.9 + 0.001 * i * several, 0.0, 0.0]) for i in range(6)]
    far = [(i, [sign, 0.01 * i if sign > 0 else 0.85 - 0.01 * i, 0.01, 0.0]) for i in range(2, 22)]
    if sign > 0:
        near = [(1, [v[0], v[1] - 0.9, 0.0, 0.0]) for _, v in near]
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + near + far
    got = ann.search(vectors(rows), F.col("vec_id") == 0, tables=1, probes=1).orderBy("rank").collect()
    s = cosines(np.array([v for _, v in rows], "f4"))[0]
    best = {}
    for (i, _), c in zip(rows[1:], s[1:]):
        best[i] = max(c, best.get(i, -2))
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [r.vec_id for r in got] == [i for i, _ in want] == [1, 2, 3, 4, 5]
    assert np.allclose([r.score for r in got], [c for _, c in want], atol=1e-12)


def test_best_of_a_block_fills_k_past_repeated_ids():
    ids = np.array([1] * 6 + list(range(2, 22)))
    x = np.array([[1.0, 0.0]] * 6 + [[1.0, 0.01 * i] for i in range(2, 22)])
    for rows in (np.arange(26), np.arange(26)[::-1]):
        _, found, _ = ann._best(ids[rows], x[rows], np.array([0]), np.array([[1.0, 0.0]]), 5)
        assert found == [1, 2, 3, 4, 5]


def brute_links(rows, least):
    ok = [(i, np.array(v, "f8")) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ok = list({(i, v.tobytes()): (i, v) for i, v in ok}.values())
    n, links = dict.fromkeys([i for i, _ in rows], 0), []
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                n[ok[a][0]] += 1
                n[ok[b][0]] += 1
                links.append((ok[a][0], ok[b][0]))
    part = {i: i for i in n}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(part[a], part[b])
            changed |= part[a] != m or part[b] != m
            part[a] = part[b] = m
    return n, part


@pytest.mark.parametrize("block, leaf", [(2048, 128), (40, 8)])
def test_grid_join_equals_brute_force(vectors, monkeypatch, block, leaf):
    monkeypatch.setattr(grid_join, "BLOCK", block)
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    x = clustered(300, 8, 6, groups=25, noise=0.14)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400 + i, x[3].tolist()) for i in range(30)] + BAD[:-1]
    rows += [(500, (2 * x[5]).tolist()), (501, [1.0, 2.0]), (502, [2.0, 4.0]), (7, x[7].tolist())]
    got = grid_join.near_duplicates(vectors(rows), 0.95).collect()
    n, part = brute_links(rows, 0.95)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], part[i], part[i] == i) for i in n}
    assert max(n.values()) > 20


def test_grid_join_nulls_and_empty(vectors):
    got = grid_join.near_duplicates(vectors([(None, [1.0, 0.0]), (4, None)])).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(None, 0, None, True), (4, 0, 4, True)}
    assert grid_join.near_duplicates(vectors([])).count() == 0


def test_distant_boxes_are_skipped():
    lo = np.array([[0.0], [1.0], [5.0]])
    assert sorted(grid_join.interval_pairs(lo, lo + 0.5, 0.6)) == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_local_components():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        i, j = rng.integers(0, n, n // 2), rng.integers(0, n, n // 2)
        root = list(range(n))
        for _ in range(n):
            for a, b in zip(i, j):
                root[a] = root[b] = min(root[a], root[b])
        assert grid_join.local_components(n, i, j).tolist() == root


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_found_on_the_whole_table(spark, sf):
    """Recall at 5 with every row of the given table as a query, against brute force."""
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect() if r["embedding"] is not None]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    score = x @ x.T
    np.fill_diagonal(score, -2)
    best = {int(i): set(ids[np.argpartition(-s, 5)[:5]].tolist()) for i, s in zip(ids, score)}
    got = ann.search(df, F.col("vec_id").isNotNull()).collect()
    assert len(got) == 5 * len(ids)
    assert sum(r["vec_id"] in best[r["query_id"]] for r in got) >= 0.95 * len(got)
