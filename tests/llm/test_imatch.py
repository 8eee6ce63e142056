import hashlib
from collections import Counter

import pytest

from vigil.llm import common, imatch

SF = "/root/testdata/sf0.001"


def test_lexicon_is_exact_on_both_paths(spark, monkeypatch):
    docs = common.table(spark, SF, "documents")
    texts = [r.text for r in docs.collect()]
    df = Counter(t for x in texts for t in imatch.terms(x))
    want = sorted(t for t, n in df.items() if max(2, 0.02 * len(texts)) <= n <= 0.2 * len(texts))
    monkeypatch.setattr(imatch, "BLOCK_DOCUMENTS", 30)
    assert imatch.lexicon(docs, 0.02, 0.2) == want
    assert imatch.lexicon(docs, 0.02, 0.2, max_candidates=0) == want


def brute(rows, words):
    """Rows with ids in order, each with its successor; null ids alone."""
    mark = imatch.Fingerprinter(words)
    known = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: -r[0])
    pairs = [(a, known[(k + 1) % len(known)][1]) for k, a in enumerate(known)]
    pairs += [((None, t or ""), t or "") for i, t in rows if i is None]
    out = []
    for (i, t), nxt in pairs:
        n = len(t)
        edited = t[:n - n // 2] + nxt[:n // 2]
        fp, ep = mark(t), mark(edited)
        out.append((str(i), n, hashlib.sha256(edited.encode()).hexdigest(), imatch.written(fp), imatch.written(ep),
                    imatch.likeness(fp, ep), imatch.likeness(fp, mark(nxt))))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("buckets", [2, 7, 50])
def test_documents_match_brute_force(spark, buckets):
    docs = common.table(spark, SF, "documents").repartition(4)
    words = imatch.lexicon(docs)
    assert rows_of(imatch.fingerprints(docs, words, buckets)) == brute([(r.doc_id, r.text) for r in docs.collect()], words)


def test_likeness(spark):
    docs = common.table(spark, SF, "documents")
    words = imatch.lexicon(docs)
    rows = imatch.fingerprints(docs, words).collect()
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    long = [r for r in rows if r.n_chars > 1000]
    mean = lambda c: sum(r[c] for r in long) / len(long)
    assert mean("near_edited") > 0.2 and mean("near_edited") > 2 * mean("near_next")
    mark = imatch.Fingerprinter(words)
    text = max((r.text for r in docs.collect()), key=len)
    assert mark(text)[0] == mark(text.upper().lower())[0]
    assert imatch.likeness(mark(text), mark(text + " zzz")) == 1.0


def test_odd_rows(frame, odd_rows):
    rows = [r for k, r in enumerate(odd_rows) if r[0] not in (1, 7) or r[0] == 1 and k == 0]
    words = imatch.lexicon(frame(odd_rows))
    assert rows_of(imatch.fingerprints(frame(rows), words, 3)) == brute(rows, words)
    assert imatch.fingerprints(frame(odd_rows), words).count() == len(odd_rows)
    assert imatch.fingerprints(frame([]), imatch.lexicon(frame([]))).count() == 0
    alone = imatch.fingerprints(frame([(5, "abcd")]), words).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0
