import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from vigil.llm import common, simhash

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TABLE))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute(rows):
    """doc_id, fingerprint, component by comparing all pairs."""
    fps = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)].append(i)
    return sorted((str(i), f"{fps[k]:016x}", str(min(ids[find(k)], default=None))) for k, (i, _) in enumerate(rows))


def found(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "word", "\x1c", "\xa0"]), max_size=9).map(" ".join) | st.text(max_size=40))
def test_fingerprint(text):
    if not any(0xD800 <= ord(c) < 0xE000 for c in text):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_documents_match_all_pairs(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.find_components(docs)) == brute(rows)


def test_odd_rows(frame, odd_rows):
    rows = [(i, t if t is None or len(t) < 1000 else t[:3000]) for i, t in odd_rows]
    docs = frame(rows)
    assert found(simhash.find_components(docs)) == brute(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for *_, c in brute(rows)}
    assert kept.count() == len(want)
    assert simhash.find_components(frame([])).count() == 0 and simhash.one_of_each(frame([])).count() == 0
    assert simhash.find_components(frame([(8, odd_rows[11][1])])).count() == 1


def near_cloud(n, seed, centres=3, flips=6):
    """Fingerprints around a few centres, and some far ones."""
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        f = rnd.choice(base) if rnd.random() < 0.8 else rnd.getrandbits(64)
        for _ in range(rnd.randrange(flips)):
            f ^= 1 << rnd.randrange(64)
        out.add(f)
    return sorted(out)


def slow_parts(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= distance):
            parent[find(i)] = find(int(j))
    groups = defaultdict(set)
    for k, f in enumerate(fps):
        groups[find(k)].add(f)
    return {frozenset(g) for g in groups.values()}


def test_tree_search_finds_every_link():
    fps = np.array(near_cloud(700, 1), np.uint64)
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    fps = fps[np.argsort(rank)]
    q, row = simhash.GrayTree(fps).search(fps, 3)
    want = {(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)}
    assert set(zip(q.tolist(), row.tolist(), strict=True)) == want


def test_split_nodes_lose_no_link(spark, tmp_path):
    common.tune(spark)
    fps = near_cloud(1200, 2)
    classes = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    nodes = simhash.upper_nodes(classes, 3, 20, str(tmp_path))
    assert nodes.select("mask").distinct().count() > 4  # some were split
    edges = simhash.links(nodes, 3)
    roots = {r.node: r.root for r in simhash.components(edges, str(tmp_path / "cc")).collect()}
    groups = defaultdict(set)
    for f in fps:
        groups[roots.get(simhash.signed(f), simhash.signed(f))].add(f)
    assert {frozenset(g) for g in groups.values()} == slow_parts(fps, 3)


def test_components_of_long_chains(spark, tmp_path):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002)] + [(5000, k) for k in range(5001, 5100)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in simhash.components(df, str(tmp_path)).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000, 1002: 1000, **{k: 5000 for k in range(5001, 5100)}}
