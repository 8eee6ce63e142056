import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from vigil.llm import common, lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=20):
    """Every document scored for every item in Python's whole numbers."""
    tf = [counted(t) for _, t in docs]
    documents, total = sum(map(bool, tf)), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    out = []
    for i, text in items:
        scored = []
        for (d, _), c in zip(docs, tf):
            if not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * documents) // total
            s = sum(q * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, q in counted(text).items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, 5, 5) for i, t in rows], "item_id long, text string, rank int, score int")


def made_up(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(300)]
    pick = lambda size: " ".join(vocabulary[min(299, int(rnd.paretovariate(0.6)) - 1)] for _ in range(size))
    docs = [(i, pick(rnd.randint(0, 200 if i % 50 else 3000))) for i in range(n)]
    return docs, [(i, pick(rnd.randint(1, 30))) for i in range(12)]


def test_equals_brute_force(frame, items_of, monkeypatch):
    docs, items = made_up(900, 1)
    want = brute(docs, items)
    table = frame(docs).repartition(4)
    assert found(lexical.ranked(table, items_of(items))) == want
    # weak first scores, small buckets, several blocks of items
    for name, value in (("SAMPLE_DOCUMENTS", 30), ("BUCKET", 16), ("BLOCK_ITEMS", 5)):
        monkeypatch.setattr(lexical, name, value)
    assert found(lexical.ranked(table, items_of(items))) == want


def test_copies_tie(frame, items_of):
    docs, items = made_up(90, 2)
    docs = [(i, "shared copy of one text" if i % 3 == 0 else t) for i, t in docs]
    items += [(50, "one shared text"), (50, "one shared text"), (51, "copy COPY copy t1")]
    assert found(lexical.ranked(frame(docs), items_of(items))) == brute(docs, items)


def test_odd_rows(frame, items_of, odd_rows):
    items = [(1, "alpha Beta"), (2, None), (3, ""), (None, "word5 number"), (4, "É é number number 7"), (1, "alpha Beta"), (5, "nothing here"), (6, "other_text 12 tail")]
    docs = odd_rows + [(30, "_-_"), (31, "a" * 100_000), (32, "İx \x85 \xa0y z z")]
    items.append((7, "a" * 100_000 + " İX z z"))
    assert found(lexical.ranked(frame(docs), items_of(items))) == brute(docs, items)
    assert found(lexical.ranked(frame([]), items_of(items))) == []
    assert found(lexical.ranked(frame([(1, None), (2, "...")]), items_of(items))) == []
    assert found(lexical.ranked(frame(docs), items_of([]))) == []


def test_bounds_leave_most_vectors_alone():
    rnd = np.random.default_rng(0)
    scorer = lexical.Scorer([(0, {0: 1, 1: 1, 2: 1})], np.array([5, 9, 400, 300]), 1000, 50_000)
    n = np.full(600, 50)
    rows = [[2, 3] if i else [0, 1, 2] for i in range(600)]
    sizes, term = np.array([len(r) for r in rows]), np.array(sum(rows, []))
    bucket = lexical.Bucket(scorer, None, n, sizes, term, rnd.integers(1, 3, len(term)))
    row, score = bucket.scored(scorer.items[0], 1)
    assert len(row) == 600
    again, same = bucket.scored(scorer.items[0], int(score[0]))
    assert again.tolist() == [0] and same[0] == score[0]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aB9_ é\x00", max_size=60), st.integers(1, 10))
def test_terms(text, size):
    if not any(0xD800 <= ord(c) < 0xE000 for c in text):
        got = [t.decode() for part in lexical.terms(text.encode(), size) for t in part]
        assert got == TERM.findall(text.translate(LOWER))


def test_query_matches_its_sql(spark):
    path = "/root/testdata/sf0.001"
    got = found(lexical.op13_lexical(spark, path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{path}/{t}.parquet'")
    assert got == sorted(con.sql(lexical.OP13_SQL).fetchall(), key=str)
    assert got
