"""Markers, commits over several sinks, late rows, compaction, concurrent and partial upserts, thinned alert state."""

import datetime as dt
import json
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import ev
from vigil.plans.ingest import load_loans
from vigil.schemas import LOANS, RATES
from vigil.sinks import commits
from vigil.sinks.lake import (commit_batch, committed_batches, compact_day, read_flagged, read_lake, read_parts,
                              stage_batch, write_flagged_batch, write_lake_batch)
from vigil.sinks.upsert import committed_versions, read_table, upsert, version
from vigil.sources.lake import read_lake_day
from vigil.sources.transactions import file_source, parse_transactions
from vigil.streaming import detector
from vigil.streaming.alerts import chunk_alerts, thin


def rows(spark, items):
    return spark.createDataFrame(items, "transaction_id string, dt string, amount double")


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_one_of_many_writers_creates_a_marker(spark, tmp_path):
    won = []

    def write(k):
        won.append((commits.publish(spark, f"{tmp_path}/m/one", {"writer": k}), k))
    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [k for ok, k in won if ok]
    assert len(winners) == 1 and commits.read(spark, f"{tmp_path}/m/one") == {"writer": winners[0]}
    assert commits.names(spark, f"{tmp_path}/m") == ["one"] and commits.names(spark, f"{tmp_path}/none") == []


def test_nothing_is_visible_before_the_last_marker(spark, tmp_path):
    lake, flagged = f"{tmp_path}/lake", f"{tmp_path}/flagged"
    one = rows(spark, [("t1", "2026-07-18", 1.0)])
    staged = stage_batch(one, lake, 0, True, "tok")
    beside = stage_batch(one.drop("dt"), flagged, 0, False, "tok")
    assert read_lake(spark, lake).isEmpty() and read_parts(spark, flagged, "transaction_id string").isEmpty()
    commit_batch(spark, flagged, {**beside, "with": lake})       # killed here: still nothing
    assert read_lake(spark, lake).isEmpty() and read_parts(spark, flagged, "transaction_id string").isEmpty()
    commit_batch(spark, lake, staged)
    assert ids(read_lake(spark, lake)) == ids(read_parts(spark, flagged)) == ["t1"]
    # the batch again, killed between its two markers: the first delivery stays
    again = rows(spark, [("t2", "2026-07-18", 1.0)])
    second = stage_batch(again, lake, 0, True, "tok2")
    commit_batch(spark, flagged, {**stage_batch(again.drop("dt"), flagged, 0, False, "tok2"), "with": lake})
    assert ids(read_parts(spark, flagged)) == ids(read_lake(spark, lake)) == ["t1"]
    commit_batch(spark, lake, second)
    assert ids(read_parts(spark, flagged)) == ids(read_lake(spark, lake)) == ["t2"]


def _landing(tmp_path, files):
    os.makedirs(f"{tmp_path}/in", exist_ok=True)
    for i, msgs in enumerate(files):
        p = f"{tmp_path}/in/part-{i}.json"
        with open(p, "w") as f:
            f.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in msgs) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{tmp_path}/in"


def test_detector_killed_between_two_sinks(spark, tmp_path, monkeypatch):
    landing = _landing(tmp_path, [[ev("a1", "C1", 0, 600000.0), "{broken", ev("big", "C2", 5, 1e17)],
                                  [ev("b1", "C1", 4000), ev("late", "C3", 3000)], [ev("c1", "C1", 4100, 700000.0), ev("late2", "C3", 0)]])
    lake, flagged, aside, late = (f"{tmp_path}/{n}" for n in ("lake", "flagged", "aside", "late"))

    def run():
        stream = parse_transactions(file_source(spark, landing, max_files_per_trigger=1))
        q = detector.start_detector(spark, stream, lake, flagged, f"{tmp_path}/ck", {"availableNow": True}, quarantine_root=aside, late_root=late)
        q.awaitTermination()

    real, calls = commit_batch, []

    def dies(spark_, root, content):
        calls.append(root)
        if len(calls) == 8:  # the last marker of the second batch
            raise RuntimeError("killed")
        real(spark_, root, content)
    monkeypatch.setattr(detector, "commit_batch", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    assert ids(read_lake(spark, lake)) == ["a1"] and ids(read_flagged(spark, flagged)) == ["a1"]
    monkeypatch.setattr(detector, "commit_batch", real)
    run()
    assert ids(read_lake(spark, lake)) == ["a1", "b1", "c1", "late"]  # batch 1 runs under batch 0's newest event
    assert ids(read_flagged(spark, flagged)) == ["a1", "b1", "c1", "late"]  # b1, late: odd hour
    assert [(r.transaction_id, r.lag_seconds) for r in read_parts(spark, late).collect()] == [("late2", 3400.0)]
    assert sorted((r.reason, r.batch_id) for r in read_parts(spark, aside).collect()) == [("amount", 0), ("corrupt", 0)]
    assert [b["rows"] for b in committed_batches(spark, lake)] == [1, 2, 1]


def test_one_day_is_read_from_its_own_folders(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for k in range(3):
        write_lake_batch(rows(spark, [(f"a{k}", "2026-07-18", 1.0), (f"b{k}", "2026-07-19", 2.0)]), root, k)
    day = read_lake_day(spark, root, "2026-07-19")
    assert ids(day) == ["b0", "b1", "b2"]
    assert all("dt=2026-07-19" in f for f in day.inputFiles()) and len(day.inputFiles()) == 3


def test_compaction_keeps_rows_and_happens_once(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for k in range(4):
        write_lake_batch(rows(spark, [(f"a{k}", "2026-07-18", 1.0), (f"b{k}", "2026-07-19", 2.0)]), root, k)
    before = sorted(map(str, read_lake(spark, root).select("transaction_id", "dt", "amount", "batch_id").collect()))
    done = []
    threads = [threading.Thread(target=lambda: done.append(compact_day(spark, root, "2026-07-19"))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == [False, True]
    assert sorted(map(str, read_lake(spark, root).select("transaction_id", "dt", "amount", "batch_id").collect())) == before
    assert len(read_lake_day(spark, root, "2026-07-19").inputFiles()) == 1
    write_lake_batch(rows(spark, [("b9", "2026-07-19", 2.0)]), root, 9)
    assert compact_day(spark, root, "2026-07-19") and not compact_day(spark, root, "2026-07-19")
    assert ids(read_lake_day(spark, root, "2026-07-19")) == ["b0", "b1", "b2", "b3", "b9"]
    assert len(read_lake_day(spark, root, "2026-07-18").inputFiles()) == 4
    with pytest.raises(ValueError, match="compacted"):
        write_lake_batch(rows(spark, [("x", "2026-07-19", 2.0)]), root, 9)


def _rates(spark, items):
    return spark.createDataFrame([(dt.date(2026, 1, 1) + dt.timedelta(days=d), r, "s") for d, r in items],
                                 "rate_date date, usd_lkr_rate double, source_url string")


def test_parallel_upserts_both_survive(spark, tmp_path):
    root = f"{tmp_path}/rates"
    upsert(spark, root, _rates(spark, [(d, 1.0) for d in range(40)]), RATES)
    gate = threading.Barrier(2, timeout=120)
    errors = []

    def run(days, rate):
        waits = [gate.wait]  # both have prepared version 2 before either publishes

        def once():
            if waits:
                waits.pop()()
        try:
            upsert(spark, root, _rates(spark, [(d, rate) for d in days]), RATES, prepared=once)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=run, args=a) for a in ((range(0, 25), 2.0), (range(20, 45), 3.0))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and committed_versions(spark, root) == [1, 2, 3]
    got = {(r.rate_date - dt.date(2026, 1, 1)).days: float(r.usd_lkr_rate) for r in read_table(spark, root, RATES).collect()}
    assert {got[d] for d in range(20)} == {2.0} and {got[d] for d in range(25, 45)} == {3.0}
    assert len({got[d] for d in range(20, 25)}) == 1 and len(got) == 45


def test_an_upsert_rewrites_the_buckets_it_touches(spark, tmp_path):
    root = f"{tmp_path}/rates"
    upsert(spark, root, _rates(spark, [(d, 1.0) for d in range(300)]), RATES, buckets=50)
    old = version(spark, root)["parts"]
    upsert(spark, root, _rates(spark, [(7, 9.0)]), RATES)
    new = version(spark, root)["parts"]
    assert len(old) > 40 and sum(old[b] != new[b] for b in old) == 1
    got = {(r.rate_date - dt.date(2026, 1, 1)).days: float(r.usd_lkr_rate) for r in read_table(spark, root, RATES).collect()}
    assert got == {**{d: 1.0 for d in range(300)}, 7: 9.0}


def test_upsert_of_nothing_and_null_keys(spark, tmp_path):
    root = f"{tmp_path}/rates"
    upsert(spark, root, _rates(spark, []), RATES)
    assert read_table(spark, root, RATES).count() == 0
    upsert(spark, root, _rates(spark, [(1, 2.0)]), RATES)
    upsert(spark, root, _rates(spark, []), RATES)
    assert read_table(spark, root, RATES).count() == 1


def test_the_later_file_of_a_load_wins(spark, tmp_path):
    """The second file is larger: Spark reads it first."""
    head = "loan_id,person_age,person_income,loan_amnt,loan_int_rate,loan_grade,loan_intent,loan_status,cb_person_default_on_file\n"
    os.makedirs(f"{tmp_path}/csv")
    with open(f"{tmp_path}/csv/a.csv", "w") as f:
        f.write(head + "L1,22,59000,1,16.02,D,PERSONAL,1,Y\n")
    with open(f"{tmp_path}/csv/b.csv", "w") as f:
        f.write(head + "L1,22,59000,2,16.02,D,PERSONAL,1,Y\n" + "".join(f"X{k},22,59000,5,16.02,D,PERSONAL,1,Y\n" for k in range(500)))
    load_loans(spark, f"{tmp_path}/csv", f"{tmp_path}/snap", f"{tmp_path}/t")
    got = {r.loan_id: float(r.loan_amnt) for r in read_table(spark, f"{tmp_path}/t", LOANS).collect()}
    assert got["L1"] == 2.0 and len(got) == 501


def test_thinned_times_give_the_same_alerts():
    rng = np.random.default_rng(11)
    for _ in range(300):
        window, threshold = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        chunks = [np.sort(rng.integers(0, 150, int(rng.integers(0, 50)))).astype("int64") for _ in range(5)]
        full = few = np.empty(0, dtype="int64")
        for c in chunks:
            a, full = chunk_alerts(full, c, window, threshold)
            b, few = chunk_alerts(few, c, window, threshold)
            few = thin(few, window, threshold - 1)
            assert a.tolist() == b.tolist()
            assert len(few) <= 2 * (threshold - 1) * (150 // window + 1)


def test_thinned_state_is_bounded():
    times = np.sort(np.random.default_rng(1).integers(0, 10**6, 200_000))
    assert len(thin(times, 10**5, 2)) == 40


def test_old_versions_go_and_readers_lose_nothing(spark, tmp_path):
    from vigil.sinks.retention import expire_versions
    root = f"{tmp_path}/rates"
    for k in range(5):
        upsert(spark, root, _rates(spark, [(d, float(k)) for d in range(k, 40)]), RATES, buckets=8)
    want = sorted(map(str, read_table(spark, root, RATES).collect()))
    assert expire_versions(spark, root, keep=1) == []                      # all of it is young
    assert expire_versions(spark, root, keep=2, grace_seconds=-1)
    assert committed_versions(spark, root)[-2:] == [4, 5] and len(committed_versions(spark, root)) < 5
    assert sorted(map(str, read_table(spark, root, RATES).collect())) == want
    upsert(spark, root, _rates(spark, [(99, 9.0)]), RATES)
    assert read_table(spark, root, RATES).count() == len(want) + 1


def test_unreachable_parts_go(spark, tmp_path):
    from vigil.sinks.retention import expire_parts
    root = f"{tmp_path}/lake"
    for k in range(3):
        write_lake_batch(rows(spark, [(f"a{k}", "2026-07-18", 1.0), (f"b{k}", "2026-07-19", 2.0)]), root, k)
    write_lake_batch(rows(spark, [("a9", "2026-07-18", 1.0)]), root, 2)   # batch 2 again
    stage_batch(rows(spark, [("lost", "2026-07-18", 1.0)]), root, 7, True)  # never committed
    compact_day(spark, root, "2026-07-18")
    want = sorted(map(str, read_lake(spark, root).select("transaction_id", "dt", "batch_id").collect()))
    assert expire_parts(spark, root) == []
    gone = expire_parts(spark, root, grace_seconds=-1)
    assert len(gone) == 2 + 3 and any("batch_id=7" in g for g in gone)
    assert sorted(map(str, read_lake(spark, root).select("transaction_id", "dt", "batch_id").collect())) == want
    assert expire_parts(spark, root, grace_seconds=-1) == []


def test_command_line(spark, tmp_path, monkeypatch):
    """detect with the quarantine on by default, alerts, trailing scores of the lake, compaction and expiry."""
    from vigil import __main__ as cli
    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    landing = _landing(tmp_path, [[ev("a1", "C1", 0), ev("a2", "C1", 20), ev("a3", "C1", 40), ev("a3", "C1", 40), "{broken", "{other", "{other"]])
    lake, flagged = f"{tmp_path}/lake", f"{tmp_path}/flagged"
    files = ["--source", "files", "--path", landing, "--once"]
    cli.main(["detect", *files, "--lake", lake, "--flagged", flagged, "--checkpoint", f"{tmp_path}/c1", "--unique"])
    assert ids(read_lake(spark, lake)) == ["a1", "a2", "a3"]
    assert sorted(r.message for r in read_parts(spark, f"{lake}-quarantine").collect()) == ["{broken", "{other"]
    cli.main(["alerts", *files, "--out", f"{tmp_path}/alerts", "--checkpoint", f"{tmp_path}/c2"])
    assert sorted({r.transaction_id for r in spark.read.parquet(f"{tmp_path}/alerts").collect()}) == ["a3"]
    cli.main(["score-trailing", "--lake", lake, "--out", f"{tmp_path}/trailing"])
    assert {r.transaction_id: r.tx_count_5m for r in spark.read.parquet(f"{tmp_path}/trailing").collect()} == {"a1": 1, "a2": 2, "a3": 3}
    cli.main(["compact-lake", "--lake", lake, "--day", "2026-07-19"])
    cli.main(["expire", "--store", lake, "--store", flagged])
    assert ids(read_lake(spark, lake)) == ["a1", "a2", "a3"]
