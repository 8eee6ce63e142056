"""Bucketed sequence operators vs brute force, with one key holding a third of the rows.

Several bucket widths are tried: results must not depend on the width
(events fall exactly on bucket edges, runs cross buckets, equal timestamps).
"""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators.dedup import dedup
from vigil.operators.sequence import islands, previous_value, running_totals, time_bucket, trailing_window

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(7)
    n = 1500
    keys = np.where(rng.random(n) < 0.34, "HOT", rng.choice([f"A{i}" for i in range(20)], n))
    secs = rng.integers(0, 3 * 86400, n)
    secs[:40] = 3600 * np.arange(40)          # exactly on hour edges
    secs[40:60] = secs[39]                      # ties at one instant
    rows = []
    for i in range(n):
        rows.append((f"t{i:05d}", None if i == 77 else str(keys[i]),
                     None if i == 88 else BASE + dt.timedelta(seconds=int(secs[i]), microseconds=int(i % 7)),
                     float(rng.integers(1, 1000)), str(rng.choice(["LK", "US", "GB"]))))
    pdf = pd.DataFrame(rows, columns=["transaction_id", "acct", "ts", "amount", "loc"])
    df = spark.createDataFrame(pdf, "transaction_id string, acct string, ts timestamp, amount double, loc string")
    return pdf, df


def _valid(pdf):
    return pdf[pdf.acct.notna() & pdf.ts.notna()].sort_values(["acct", "ts", "transaction_id"])


@pytest.mark.parametrize("bucket", [60, 3600, 86400, 10 ** 7])
def test_previous_value(events, bucket):
    pdf, df = events
    got = previous_value(df, "acct", "ts", ["loc", "ts"], time_bucket("ts", bucket), ["transaction_id"])
    got = {r.transaction_id: (r.prev_loc, r.prev_ts) for r in got.collect()}
    v = _valid(pdf)
    exp = dict(zip(v.transaction_id, zip(v.groupby("acct").loc.shift(), v.groupby("acct").ts.shift())))
    for tid, (ploc, pts) in exp.items():
        g = got[tid]
        assert g[0] == (None if pd.isna(ploc) else ploc)
        assert (g[1] is None) == pd.isna(pts) and (g[1] is None or pd.Timestamp(g[1]) == pts)
    assert got["t00077"] == (None, None) and got["t00088"] == (None, None)
    assert len(got) == len(pdf)


@pytest.mark.parametrize("bucket", [60, 3600, 86400])
def test_running_totals(events, bucket):
    pdf, df = events
    got = running_totals(df, "acct", "ts", "amount", time_bucket("ts", bucket), ["transaction_id"])
    got = {r.transaction_id: (r.prior_count, r.prior_sum) for r in got.collect()}
    v = _valid(pdf)
    cnt = v.groupby("acct").cumcount()
    tot = v.groupby("acct").amount.cumsum() - v.amount
    for tid, c, s in zip(v.transaction_id, cnt, tot):
        assert got[tid] == (c, s)
    assert got["t00077"] == (None, None)


@pytest.mark.parametrize("bucket", [60, 3600, 86400])
def test_trailing_window(events, bucket):
    pdf, df = events
    window = 1800
    got = trailing_window(df, "acct", "ts", "amount", window, bucket_seconds=bucket)
    assert got.count() == len(pdf)
    got = {r.transaction_id: (r.trail_count, r.trail_sum, r.trail_max) for r in got.collect()}
    v = _valid(pdf)
    for acct, g in v.groupby("acct"):
        t = g.ts.to_numpy()
        a = g.amount.to_numpy()
        for tid, ti in zip(g.transaction_id, t):
            m = (t >= ti - np.timedelta64(window, "s")) & (t <= ti)
            assert got[tid] == (m.sum(), a[m].sum(), a[m].max()), tid
    assert got["t00088"] == (None, None, None)


def test_islands(events):
    pdf, df = events
    got = islands(df, "acct", "ts", 600.0, bucket_seconds=3600, tiebreak=["transaction_id"])
    got = {r.transaction_id: r.island for r in got.collect()}
    v = _valid(pdf)
    gap = v.groupby("acct").ts.diff().dt.total_seconds()
    start = (gap.isna() | (gap > 600)).astype(int)
    exp = start.groupby(v.acct).cumsum()
    for tid, isl in zip(v.transaction_id, exp):
        assert got[tid] == isl


def test_dedup_hot_key(spark):
    rows = [("k1", i, f"v{i}") for i in range(500)] + [("k2", 5, "a"), ("k2", 3, "b"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    first = {r.k: (r.t, r.v) for r in dedup(df, "k", "t").collect()}
    last = {r.k: (r.t, r.v) for r in dedup(df, "k", "t", keep="last").collect()}
    assert first == {"k1": (0, "v0"), "k2": (3, "b"), None: (1, "n")}
    assert last["k1"] == (499, "v499") and last["k2"] == (5, "a")
    assert dedup(df, "k", "t").columns == ["k", "t", "v"]


@pytest.mark.parametrize("hot_rows", [3, 50])
def test_hot_buckets_are_cut_and_give_the_same(events, hot_rows):
    """Buckets of more than a few rows are parted; ties, edges and rows without a sequence included."""
    pdf, df = events
    for bucket in (3600, 10 ** 7):
        b = time_bucket("ts", bucket)
        for make in (lambda **k: previous_value(df, "acct", "ts", ["loc", "ts"], b, ["transaction_id"], **k),
                     lambda **k: running_totals(df, "acct", "ts", "amount", b, ["transaction_id"], **k),
                     lambda **k: islands(df, "acct", "ts", 600.0, bucket, ["transaction_id"], **k)):
            cut, whole = make(hot_rows=hot_rows), make()
            assert cut.columns == whole.columns
            assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_an_account_with_a_third_of_the_rows_in_one_hour_is_spread(spark):
    from vigil.operators.sequence import parted
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), (F.col("id") % 997).cast("string"))).alias("acct"),
        F.timestamp_seconds(F.lit(1_700_000_400) + F.pmod(F.xxhash64("id"), F.lit(3600))).alias("ts"))
    t = parted(df, "acct", "ts", time_bucket("ts", 3600), F.lit(True), hot_rows=1000)
    sizes = {(r.acct, r._p): r["count"] for r in t.groupBy("acct", "_p").count().collect()}
    hot = [c for (a, _), c in sizes.items() if a == "HOT"]
    assert len(hot) > 200 and max(hot) < 2 * (n / 3) / len(hot) and all(p == 0 for a, p in sizes if a != "HOT")


def test_trailing_window_takes_one_scan_and_one_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F
    spark.range(100).select(F.concat(F.lit("a"), F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("t"),
                            F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "x"))
    plan = trailing_window(spark.read.parquet(str(tmp_path / "x")), "k", "t", "v", 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
