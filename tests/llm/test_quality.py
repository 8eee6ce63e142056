import math
import zlib

import numpy as np
import zstandard

from vigil.llm import common, quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = quality.train(docs, labels)
    rows = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    truth = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(r.predicted == q for r, q in truth) / len(truth) >= 0.9
    good = [r.predicted for r, q in truth if q == 1]
    assert sum(good) / len(good) >= 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    assert quality.train(docs, labels) == quality.train(docs, turned)


def test_score_reads_the_text_only(frame, spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = quality.train(docs, labels)
    texts = ["Same text here and there.", "", None]
    a = quality.score(frame([(i, t) for i, t in enumerate(texts)]), model).orderBy("doc_id").collect()
    b = quality.score(frame([(90 + i, t) for i, t in enumerate(texts)], extra=False), model).orderBy("doc_id").collect()
    assert [r.score for r in a] == [r.score for r in b]
    assert a[1].score == a[2].score


def test_odd_rows_and_missing_labels(frame, odd_rows, spark):
    docs = frame(odd_rows)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.constant == 1.0
    assert quality.score(docs, model).count() == len(odd_rows)
    none = quality.train(frame([]), labels)
    assert none.constant == 0.5 and quality.score(frame([]), none).count() == 0
    assert quality.accepted(docs, none).columns == docs.columns
    assert quality.accepted(docs, none).count() == len(odd_rows)
    few = quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(1, 13)], "doc_id long, quality int"))
    assert quality.score(docs, few).where("score is null").count() == 0


def plain_features(dictionaries, text):
    """The two compressed sizes, chunk by chunk, and what follows from them."""
    raw = text.encode()
    parts = [raw[i:i + 1024] for i in range(0, len(raw), 1024)] or [b""]
    sizes = []
    for d in dictionaries:
        c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                     write_content_size=False, write_dict_id=False)
        sizes.append(sum(len(c.compress(x)) for x in parts))
    bad, good = sizes
    n = len(raw) + 20
    return [(bad - good) / (bad + good), (bad - good) / n, good / n, (good / n) ** 2, math.log(n)]


def test_scores_equal_a_plain_recomputation(spark):
    """Dictionaries, calibration and every score, recomputed without Spark; the sizes' difference alone ranks well."""
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = quality.train(docs, labels)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    label = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    spots = {r.doc_id: (r.at, r.c) for r in spark.createDataFrame([(i,) for i in label], "doc_id long").selectExpr(
        "doc_id", "xxhash64(doc_id, 'sample') at", "pmod(xxhash64(doc_id, 'part'), 3) = 0 c").collect()}
    spread = {(r.at, r.k): r.h for r in spark.createDataFrame(
        [(spots[i][0], k) for i in label for k in range(len(text[i].encode()) // 1024 + 1)], "at long, k long").selectExpr("at", "k", "xxhash64(at, k) h").collect()}
    for want in (0, 1):
        chunks = []
        for i, y in label.items():
            if y == want and not spots[i][1]:
                raw = text[i].encode()
                chunks += [(spread[spots[i][0], k], raw[1024 * k:1024 * (k + 1)]) for k in range(max(1, -(-len(raw) // 1024)))]
        assert quality.build_dictionary([c for _, c in sorted(chunks)[:5000]]) == model.dictionaries[want]
    known = [i for i in label if spots[i][1]]
    x, y = np.array([plain_features(model.dictionaries, text[i]) for i in known]), np.array([label[i] for i in known])
    assert np.allclose(x.mean(0), model.mean) and np.allclose(x.std(0) + 1e-9, model.scale)
    z = np.c_[np.ones(len(x)), (x - model.mean) / model.scale]
    slope = z.T @ (y - 1 / (1 + np.exp(-z @ np.array(model.weights)))) - 1e-2 * np.array(model.weights)
    assert np.abs(slope).max() < 1e-3  # the weights are the optimum of the ridge logistic loss
    for r in quality.score(docs, model).collect():
        f = (np.array(plain_features(model.dictionaries, text[r.doc_id])) - model.mean) / model.scale
        assert abs(r.score - 1 / (1 + math.exp(-(model.weights[0] + f @ np.array(model.weights[1:]))))) < 1e-9
    difference = sorted((plain_features(model.dictionaries, text[i])[0], label[i]) for i in known)
    ranks = [k for k, (_, y) in enumerate(difference) if y == 1]
    wins = sum(ranks) - len(ranks) * (len(ranks) - 1) / 2
    assert wins / (len(ranks) * (len(known) - len(ranks))) > 0.95


def test_repeated_rows_teach_once(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    assert quality.train(docs.unionByName(docs).unionByName(docs), labels) == quality.train(docs, labels)
