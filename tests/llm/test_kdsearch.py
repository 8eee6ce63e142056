import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from vigil.llm import common, kdsearch

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("score", T.StringType()), T.StructField("kth", T.StringType())])


def brute(rows, every=100, k=10):
    """Every query row against all other rows, in Python's whole numbers."""
    ok = []
    for p, (i, e) in enumerate(rows):
        if e is not None and all(x is not None and np.isfinite(x) and np.isfinite(np.float64(x) * 1024) for x in e):
            ok.append((p, i, [int(np.floor(np.float64(x) * 1024)) for x in e]))
    out = []
    for p, i, q in ok:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for p2, j, v in ok if p2 != p and len(v) == len(q)]
        out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def frame_of(spark):
    common.tune(spark)
    return lambda rows: spark.createDataFrame([(i, e, "x", "y") for i, e in rows], VECTORS).repartition(3)


def clustered(n, dim, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(5, dim))
    return [[float(x) for x in centres[rnd.integers(5)] + rnd.normal(size=dim) * 0.2] for _ in range(n)]


def test_equals_brute_force_with_many_small_shards(frame_of):
    rows = list(enumerate(clustered(700, 8, 1)))
    assert found(kdsearch.top_k(frame_of(rows), every=25, shard_rows=40)) == brute(rows, 25)


def test_one_vector_holds_a_third_of_the_rows(frame_of):
    v = clustered(600, 6, 2)
    rows = [(i, v[0] if i % 3 == 0 else e) for i, e in enumerate(v)]
    assert found(kdsearch.top_k(frame_of(rows), every=20, shard_rows=50)) == brute(rows, 20)


def test_odd_rows(frame_of):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.5, -0.25]), (1, None), (200, None), (2, [1.0, None]), (3, [nan, 1.0]), (300, [inf, 1.0]),
            (4, [1e306, 1.0]), (None, [3.0, 1.0]), (None, [3.0, 1.0]), (5, [3.0, 1.0]), (400, [1.0, 2.0, 3.0]), (6, [1.0, 2.0, 3.0]),
            (500, [5.0]), (600, []), (7, []), (8, [-1e-9, 1e-9]), (700, [0.0, 0.0]), (-100, [-2.0, 7.0])]
    assert found(kdsearch.top_k(frame_of(rows))) == brute(rows)
    assert found(kdsearch.top_k(frame_of([]))) == []
    assert found(kdsearch.top_k(frame_of([(100, [1.0])]))) == []
    assert found(kdsearch.top_k(frame_of([(100, []), (1, [])]))) == [(100, 1, 1, 0)]


def test_sums_beyond_doubles_are_exact(frame_of):
    rows = [(0, [2.0**20, 1.0 / 1024, 2.0**19]), (1, [2.0**20, 1.0 / 512, 3.0]), (2, [2.0**20, 1.0 / 1024, 3.0]), (3, [2.0**20, 3.0 / 1024, 3.0])]
    assert found(kdsearch.top_k(frame_of(rows))) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 5), st.integers(1, 12), st.integers(0, 10**6))
def test_tree_search_with_ties(n, dim, k, seed):
    rnd = np.random.default_rng(seed)
    rows = rnd.integers(-3, 4, size=(n, dim)).astype(float)
    ids, pos = rnd.integers(0, 50, n), rnd.permutation(n)
    tree = kdsearch.KdTree(rows, ids, leaf=8)
    q = rnd.integers(-3, 4, size=(9, dim)).astype(float)
    own = np.concatenate([pos[:min(4, n)], np.full(9 - min(4, n), -1)])
    got = tree.search(q, own, pos, np.full(9, -np.inf), np.full(9, kdsearch.NO_ID), k)
    for i in range(9):
        want = sorted((-(q[i] @ rows[j]), ids[j], pos[j]) for j in range(n) if pos[j] != own[i])[:k]
        assert [(-s, ids[r], pos[r]) for a, s, r in zip(*got) if a == i] == want
    # scores and ids to beat: nothing better is lost
    kth, kth_id = np.full(9, 2.0), np.full(9, 20)
    got = tree.search(q, own, pos, kth.copy(), kth_id.copy(), k)
    for i in range(9):
        want = sorted((-(q[i] @ rows[j]), ids[j], pos[j]) for j in range(n) if pos[j] != own[i])[:k]
        better = [w for w in want if w[:2] < (-2.0, 20)]
        assert [(-s, ids[r], pos[r]) for a, s, r in zip(*got) if a == i][:len(better)] == better


def test_tree_leaves_most_rows_alone():
    rows = np.floor(1024 * np.array(clustered(20_000, 4, 3)))
    tree = kdsearch.KdTree(rows, np.arange(len(rows)))
    seen = []
    bound = tree.bound
    tree.bound = lambda q, node: (seen.append(len(q)), bound(q, node))[1]
    tree.search(rows[:50], np.arange(50), np.arange(len(rows)), np.full(50, -np.inf), np.full(50, kdsearch.NO_ID))
    assert sum(seen) < 0.25 * 50 * len(tree.start)


def test_query_matches_its_sql(spark):
    path = "/root/testdata/sf0.01"
    got = found(kdsearch.op11_kdsearch(spark, path))
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    assert got == sorted(con.sql(kdsearch.OP11_SQL).fetchall(), key=str)
