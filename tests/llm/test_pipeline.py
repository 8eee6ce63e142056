"""The pipeline's stages against brute-force versions, each on its own input."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_exact import TABLE
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute as components
from vigil.llm import common, pii, quality

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_one_after_another(spark, tmp_path):
    docs = common.table(spark, SF, "documents")
    # near copies of the longest documents: one word more, one word less
    longest = docs.orderBy(F.desc("n_chars"), "doc_id").limit(20)
    docs = (docs.unionByName(longest.withColumns({"doc_id": F.col("doc_id") + 10_000, "text": F.concat("text", F.lit(" tail"))}))
            .unionByName(longest.withColumns({"doc_id": F.col("doc_id") + 20_000, "text": F.regexp_replace("text", " \\S+$", "")})))
    docs.write.parquet(str(tmp_path / "start"))
    docs = spark.read.parquet(str(tmp_path / "start"))
    first = docs
    model = quality.train(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))
    outs = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outs.append(docs)
    start = rows(first)
    good = [(i, t) for i, t in start if quality.probability(model, t or "") >= quality.THRESHOLD]
    assert rows(outs[0]) == good and len(good) < len(start)

    last = {}
    for i, t in good:
        last[t.translate(TABLE)] = max(i, last.get(t.translate(TABLE), i))
    exact = [(i, t) for i, t in good if last[t.translate(TABLE)] == i]
    assert rows(outs[1]) == exact

    keep = {c for _, _, c in components(exact)}
    near = [(i, t) for i, t in exact if str(i) in keep]
    assert rows(outs[2]) == near and len(near) < len(exact)

    hidden = [(i, pii.masked(t, pii.find_spans(t))) for i, t in near]
    assert rows(outs[3]) == hidden
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w", t) for _, t in hidden)
    assert {r.doc_id: r.n_chars for r in outs[3].collect()} == {i: len(t) for i, t in hidden}
    check(outs[4].collect(), hidden, 2048)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_odd_rows(frame, odd_rows, spark, tmp_path):
    docs = frame([(i, t if t is None or len(t) < 500 else t[:500]) for i, t in odd_rows])
    for name, stage in corpus_pipeline.STAGES:
        for table, kind in ((docs, "odd"), (docs.where("false"), "empty")):
            out = stage(spark, table, SF)
            if name != "packing":
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}-{kind}"))
        assert spark.read.parquet(str(tmp_path / f"{name}-empty")).count() == 0
    groups = defaultdict(list)
    for i, t in ((r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "exact_dedup-odd")).collect()):
        groups[hashlib.sha256((t or "").translate(TABLE).encode()).hexdigest()].append(i)
    assert all(len(g) == 1 for g in groups.values())
