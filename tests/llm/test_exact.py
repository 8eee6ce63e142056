import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from vigil.llm import exact

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(TABLE)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        done = False
        for i in ids:
            kept = i == keep and not done
            done |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def test_groups_match_brute_force(frame, odd_rows):
    found = exact.find_duplicates(frame(odd_rows))
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect())
    assert got == brute(odd_rows)
    assert {"text", "lang", "score", "n_chars"} <= set(found.columns)


def test_one_row_of_each_group_stays_whole(frame, odd_rows):
    docs = frame(odd_rows)
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    want = Counter((i, h) for (i, _, _, k, h), n in brute(odd_rows).items() if k for _ in range(n))
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").translate(TABLE).encode()).hexdigest()) for r in kept.collect()) == want


def test_empty_table(frame):
    assert exact.find_duplicates(frame([])).count() == 0
    assert exact.deduplicated(frame([])).count() == 0


def test_directory_splits_overfull_buckets_only(spark):
    # one hot cell, one warm neighbour, the rest sparse
    cells = spark.createDataFrame([(0, 50), (1, 30), (2 ** 13, 5)], "cell long, entries long")
    got = {(r.depth, r.prefix, r.entries) for r in exact.build_directory(cells, 60).collect()}
    assert (1, 1, 5) in got  # upper half never split
    assert (exact.MAX_DEPTH, 0, 50) in got and (exact.MAX_DEPTH, 1, 30) in got
    assert sum(e for *_, e in got) == 85


def test_index_files_cover_all_texts(frame, spark, tmp_path):
    docs = frame([(i, f"text {i}") for i in range(3000)])
    entries = exact.build_index(docs, str(tmp_path), min_capacity=100)
    buckets = spark.read.parquet(f"{tmp_path}/directory")
    assert entries.count() == 3000 and buckets.agg({"entries": "max"}).first()[0] <= 100
    loads = {(r.depth, r.prefix): r["count"] for r in entries.groupBy("depth", "prefix").count().collect()}
    assert loads == {(r.depth, r.prefix): r.entries for r in buckets.collect()}


def _rows(found):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect())


def test_texts_of_one_hash_chain_and_are_compared(frame, odd_rows, monkeypatch, spark, tmp_path):
    # four hashes for all texts: equality is settled by bytes in the owners' chains
    monkeypatch.setattr(exact, "hash_of", lambda t: F.xxhash64(t).bitwiseAND(F.lit(3)).cast("long"))
    rows = odd_rows + [(i, f"text {i % 40}") for i in range(200)]
    assert _rows(exact.find_duplicates(frame(rows))) == brute(rows)
    entries = exact.build_index(frame(rows), str(tmp_path)).collect()
    assert len({r["_h"] for r in entries}) <= 4
    for h in {r["_h"] for r in entries}:
        chain = sorted(r.chain for r in entries if r["_h"] == h)
        assert chain == list(range(1, len(chain) + 1))


def test_hot_texts_meet_in_their_owners_chain(frame, spark, tmp_path):
    rows = [(i, "Hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    got = exact.build_index(frame(rows), str(tmp_path), hot_rows=10).collect()
    assert len(got) == len({t.lower() for _, t in rows})
    (hot,) = [r for r in got if r.group_size > 2]
    assert (hot.group_size, hot.keep_id) == (1000, 2997)
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 1


def test_owners_hold_whole_buckets(frame, tmp_path):
    entries = exact.build_index(frame([(i, f"text {i}") for i in range(2000)]), str(tmp_path), min_capacity=100)
    files = entries.withColumn("file", F.input_file_name()).groupBy("prefix", "depth").agg(F.countDistinct("file").alias("files")).collect()
    assert len(files) > 10 and {r.files for r in files} == {1}


def test_documents_find_entries_through_the_directory_only(frame, spark):
    docs = frame([(i, f"text {i}") for i in range(50)])
    pointers, _ = exact._indexed(docs)
    assert exact._keyed(docs, pointers).count() == 50
    assert exact._keyed(docs, pointers.where("_cell < 0")).count() == 0


def test_tied_rows_keep_one(frame):
    rows = [(7, "same")] * 300 + [(None, "")] * 200 + [(None, None)] * 100 + [(1, "same"), (2, "other")]
    assert _rows(exact.find_duplicates(frame(rows).repartition(6))) == brute(rows)
    kept = exact.deduplicated(frame(rows).repartition(6)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (2, "other"), (7, "same")]


def test_bounded_tables_are_written_to_few_files(frame, spark, tmp_path):
    """Cells and directory have a bounded number of rows: not one small file for each shuffle partition."""
    from pathlib import Path
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        entries = exact.build_index(frame([(i, f"text {i}") for i in range(2000)]), str(tmp_path), min_capacity=100)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert entries.count() == 2000
    for name in ("cells", "directory"):
        assert 1 <= len(list(Path(tmp_path, name).glob("part-*"))) <= exact.SMALL_FILES
