"""Upsert semantics against a dict model, versioned writes, idempotent lake writes."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from vigil.schemas import LOANS, RATES
from vigil.sinks.lake import (overwrite_partitions, read_flagged, write_flagged_batch, write_if_absent,
                              write_lake_batch)
from vigil.sinks.upsert import committed_versions, merge_frames, read_table, upsert
from vigil.sources.lake import read_lake_day, union_shards

SCHEMA = "k string, a int, b string, seq int"


def test_merge_null_overwrites_and_kept_columns(spark):
    target = spark.createDataFrame([("x", 1, "keep"), ("y", 2, "old"), ("z", 3, "zz")], "k string, a int, b string")
    source = spark.createDataFrame([("x", None, "new", 1), ("y", 20, None, 1), ("w", 9, "ins", 1)], SCHEMA)
    got = {r.k: (r.a, r.b) for r in merge_frames(target, source, ["k"], update_cols=["a"], order="seq").collect()}
    # a (updatable) takes the source value even when null; b (kept) keeps the target value
    assert got == {"x": (None, "keep"), "y": (20, "old"), "z": (3, "zz"), "w": (9, "ins")}


def test_merge_last_wins_random_against_model(spark):
    rng = np.random.default_rng(3)
    model = {f"k{i}": (int(rng.integers(0, 100)), "t") for i in range(50)}
    target = spark.createDataFrame([(k, a, b) for k, (a, b) in model.items()], "k string, a int, b string")
    src_rows = []
    for seq in range(300):
        k = f"k{int(rng.integers(0, 80))}"
        src_rows.append((k, int(rng.integers(0, 1000)), f"s{seq}", seq))
    expect = dict(model)
    for k, a, b, _seq in src_rows:          # applied in order: the last row per key wins
        expect[k] = (a, b)
    source = spark.createDataFrame(src_rows, SCHEMA)
    got = {r.k: (r.a, r.b) for r in merge_frames(target, source, ["k"], order="seq").collect()}
    assert got == expect


def test_upsert_versions_and_rerun(spark, tmp_path):
    root = str(tmp_path / "loans")
    now1 = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    load1 = spark.createDataFrame(
        [("L1", "25", "1000", "D", 1, 1), ("L2", "30", "2000", "b", 0, 1)],
        "loan_id string, person_age string, loan_amnt string, loan_grade string, loan_status int, seq int")
    upsert(spark, root, load1, LOANS, order="seq", now=now1)
    # second load: age must not change (N17), amount must; repeated id -> last wins
    load2 = spark.createDataFrame(
        [("L1", "99", "1500", "D", 1, 1), ("L1", "98", "1600", "D", 0, 2), ("L3", "40", "10", "a", None, 1)],
        "loan_id string, person_age string, loan_amnt string, loan_grade string, loan_status int, seq int")
    upd = ["person_income", "loan_amnt", "loan_int_rate", "loan_grade", "loan_intent", "loan_status"]
    now2 = F.lit(dt.datetime(2026, 1, 2)).cast("timestamp")
    upsert(spark, root, load2, LOANS, update_cols=upd, order="seq", now=now2)
    t = {r.loan_id: r for r in read_table(spark, root, LOANS).collect()}
    assert t["L1"].person_age == 25 and float(t["L1"].loan_amnt) == 1600.0 and t["L1"].loan_status == 0
    assert t["L1"].loaded_at == dt.datetime(2026, 1, 2)
    assert t["L2"].loaded_at == dt.datetime(2026, 1, 1) and t["L2"].loan_grade == "b"
    assert t["L3"].person_age == 40 and t["L3"].loan_status is None
    assert committed_versions(spark, root) == [1, 2]
    # a half-written version (no _SUCCESS) is ignored and then overwritten
    os.makedirs(os.path.join(root, "v=00000003"))
    open(os.path.join(root, "v=00000003", "part-garbage.parquet"), "w").write("x")
    assert committed_versions(spark, root) == [1, 2]
    upsert(spark, root, load2, LOANS, update_cols=upd, order="seq", now=now2)
    t2 = {r.loan_id: r for r in read_table(spark, root, LOANS).collect()}
    assert t2 == t                           # re-running the same load changes nothing
    assert committed_versions(spark, root) == [1, 2, 3]


def test_rate_upsert_by_date(spark, tmp_path):
    root = str(tmp_path / "rates")
    d = dt.date(2026, 7, 19)
    upsert(spark, root, spark.createDataFrame([(d, 300.5, "a")], "rate_date date, usd_lkr_rate double, source_url string"), RATES)
    upsert(spark, root, spark.createDataFrame([(d, 301.25, "b")], "rate_date date, usd_lkr_rate double, source_url string"), RATES)
    rows = read_table(spark, root, RATES).collect()
    assert len(rows) == 1 and float(rows[0].usd_lkr_rate) == 301.25 and rows[0].source_url == "b"


def _lake(spark):
    return spark.createDataFrame(
        [("t1", "2026-07-18", 1.0), ("t2", "2026-07-19", 2.0), ("t3", "2026-07-19", 3.0)],
        "transaction_id string, dt string, amount double")


def test_lake_batch_replay_replaces_own_output(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_lake_batch(_lake(spark), root, 0)
    write_lake_batch(_lake(spark).where("dt = '2026-07-19'"), root, 1)
    # batch 1 replayed with different content: its old rows and its old days disappear
    write_lake_batch(_lake(spark).where("transaction_id = 't1'"), root, 1)
    day = read_lake_day(spark, root, "2026-07-19")
    assert sorted(r.transaction_id for r in day.collect()) == ["t2", "t3"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert read_lake_day(spark, root, "2026-07-18").count() == 2


def test_flagged_store_first_detection_wins(spark, tmp_path):
    root = str(tmp_path / "flagged")
    a = spark.createDataFrame([("t1", "odd_hour", dt.datetime(2026, 1, 1))], "transaction_id string, rule_name string, detected_at timestamp")
    b = spark.createDataFrame([("t1", "rapid_fire", dt.datetime(2026, 1, 2)), ("t2", "x", dt.datetime(2026, 1, 2))],
                              "transaction_id string, rule_name string, detected_at timestamp")
    write_flagged_batch(a, root, 0)
    write_flagged_batch(b, root, 1)
    write_flagged_batch(b, root, 1)          # replay
    got = {r.transaction_id: r.rule_name for r in read_flagged(spark, root).collect()}
    assert got == {"t1": "odd_hour", "t2": "x"}


def test_partition_overwrite_and_write_if_absent(spark, tmp_path):
    root = str(tmp_path / "rates_lake")
    overwrite_partitions(_lake(spark), root)
    overwrite_partitions(_lake(spark).where("dt = '2026-07-19'").withColumn("amount", F.lit(9.0)), root)
    got = {r.transaction_id: r.amount for r in spark.read.parquet(root).collect()}
    assert got == {"t1": 1.0, "t2": 9.0, "t3": 9.0}
    p = str(tmp_path / "once")
    write_if_absent(_lake(spark), p)
    write_if_absent(_lake(spark).limit(1), p)
    assert spark.read.parquet(p).count() == 3


def test_union_shards_with_drift(spark):
    a = spark.createDataFrame([("t1", 1.0)], "transaction_id string, amount double")
    b = spark.createDataFrame([("t2", 2.0, "LK")], "transaction_id string, amount double, location string")
    u = union_shards([a, b])
    assert u.columns == ["transaction_id", "amount", "location"] and u.count() == 2
