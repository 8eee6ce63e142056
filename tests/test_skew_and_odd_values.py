"""Null keys, hot keys, NaN, duplicates, chunked batches and values that do not fit."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from vigil.operators.joins import salted_left_join
from vigil.operators.sequence import previous_value, running_totals, time_bucket, trailing_window
from vigil.operators.stats import account_stats, attach_stats
from vigil.plans.marts import amount_lkr_asof, latest_rate
from vigil.schemas import DAILY_SUMMARY, FLAGGED, RAW, conform, misfits
from vigil.streaming.detector import make_batch_writer, quarantine

T0 = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def sequence(spark, n, keys=("a", "b", None), seed=1, span=4000):
    rnd = random.Random(seed)
    rows = [(str(i), rnd.choice(keys), at(rnd.randrange(span)) if rnd.random() > 0.1 else None,
             rnd.choice([None, float("nan"), 1.0, 2.0, 5.0])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, k string, t timestamp, v double")


def brute_trailing(rows, seconds):
    out = {}
    for i, k, t, _ in rows:
        if k is None or t is None:
            out[i] = (None, None, None)
            continue
        seen = [x for _, k2, t2, x in rows if k2 == k and t2 is not None and dt.timedelta(0) <= t - t2 <= dt.timedelta(seconds=seconds) and x is not None]
        real = [x for x in seen if x == x]
        out[i] = (len(seen), sum(real) if real else None, max(real) if real else None)
    return out


@pytest.mark.parametrize("seconds", [1, 60, 300, 5000])
def test_trailing_window_matches_brute_force(spark, seconds):
    rows, df = sequence(spark, 400)
    got = {r.id: (r.trail_count, r.trail_sum, r.trail_max) for r in trailing_window(df, "k", "t", "v", seconds).collect()}
    assert got == brute_trailing(rows, seconds)


def test_trailing_window_is_linear_in_a_hot_key(spark):
    def seconds(n):
        df = spark.range(n).selectExpr("'hot' as k", "timestamp_seconds(id % 3000) as t", "cast(id as double) as v")
        began = time.time()
        trailing_window(df, "k", "t", "v", 3600).write.format("noop").mode("overwrite").save()
        return time.time() - began
    seconds(20_000)
    assert seconds(160_000) < 10 * max(0.5, seconds(40_000))  # quadratic: 16 times


def test_nan_amounts_add_nothing_to_later_totals(spark):
    rows = [("1", "a", at(1), 10.0), ("2", "a", at(2), float("nan")), ("3", "a", at(3), 20.0), ("4", "a", at(4), 1.0)]
    df = spark.createDataFrame(rows, "id string, k string, t timestamp, v double")
    got = {r.id: (r.prior_sum, r.prior_count) for r in running_totals(df, "k", "t", "v", time_bucket("t", 2)).collect()}
    assert got == {"1": (0.0, 0), "2": (10.0, 1), "3": (10.0, 2), "4": (30.0, 3)}


def largest_share(df):
    """Rows of the largest partition over the mean of those with rows."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) * len(sizes) / sum(sizes)


@pytest.fixture()
def plain_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_and_hot_keys_spread(spark, plain_shuffles):
    """Half the rows without a key, a third with one key: no task has twice the mean."""
    df = spark.range(24_000).selectExpr(
        "cast(id as string) as transaction_id", "case when id % 2 = 0 then null when id % 6 = 1 then 'hot' else concat('c', id % 997) end as nameOrig",
        "timestamp_seconds(id) as event_time", "cast(id % 50 as double) as amount").repartition(8, "transaction_id")
    stats = account_stats(df)
    assert largest_share(attach_stats(df, stats, hot_rows=100)) < 2
    assert largest_share(salted_left_join(df, stats, "nameOrig", F.col("tx_count_5m"), hot_rows=100)) < 2
    bucket = time_bucket("event_time", 60)
    assert largest_share(previous_value(df, "nameOrig", "event_time", ["amount"], bucket, ["transaction_id"])) < 2
    assert largest_share(running_totals(df, "nameOrig", "event_time", "amount", bucket, ["transaction_id"])) < 2
    assert largest_share(trailing_window(df, "nameOrig", "event_time", "amount", 60)) < 2
    assert attach_stats(df, stats, hot_rows=100).count() == 24_000


def test_salts_do_not_depend_on_the_order_of_rows(spark):
    df = spark.range(2000).selectExpr("id", "'hot' as k")
    right = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    a = salted_left_join(df, right, "k", F.col("n"), hot_rows=10)
    b = salted_left_join(df.repartition(7).orderBy(F.desc("id")), right, "k", F.col("n"), hot_rows=10)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 2000


def test_duplicate_rate_dates_give_one_rate(spark):
    d = dt.date
    rates = spark.createDataFrame([(d(2026, 1, 1), 300.0, T0), (d(2026, 1, 5), 310.0, T0), (d(2026, 1, 5), 311.0, at(9)), (d(2026, 1, 5), 309.0, at(9))],
                                  "rate_date date, usd_lkr_rate double, loaded_at timestamp")
    rates = rates.withColumn("usd_lkr_rate", F.col("usd_lkr_rate").cast("decimal(10,4)"))
    events = spark.createDataFrame([(d(2026, 1, k), "1.00") for k in (1, 4, 5, 9)], "event_date date, amount string")
    got = {r.event_date.day: float(r.rate_asof) for r in amount_lkr_asof(events.withColumn("amount", F.col("amount").cast("decimal(18,2)")), rates).collect()}
    assert got == {1: 300.0, 4: 300.0, 5: 311.0, 9: 311.0}
    assert amount_lkr_asof(events, rates).count() == 4
    assert float(latest_rate(rates).first().usd_lkr_rate) == 311.0


def test_wide_counts_and_misfits(spark):
    day = spark.createDataFrame([(dt.date(2026, 1, 1), 3_000_000_000, 5)], "summary_date date, total_txns long, flagged_count long")
    assert conform(day, DAILY_SUMMARY).first().total_txns == 3_000_000_000
    rows = spark.createDataFrame([("a", 1e17, at(0)), ("b", 5.0, at(0)), ("c", None, at(0))], "transaction_id string, amount double, event_time timestamp")
    assert {r.transaction_id: r.amount is None for r in conform(rows, FLAGGED).collect()} == {"a": True, "b": False, "c": True}
    assert {r.transaction_id: r.m for r in rows.select("transaction_id", misfits(rows, RAW).alias("m")).collect()} == {"a": "amount", "b": None, "c": None}


def test_poison_event_goes_to_the_quarantine(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from vigil.sources import derived
    from vigil.sources.transactions import parse_transactions
    parse_transactions(derived.raw_wire(spark, SF_SMALL)).write.parquet(str(tmp_path / "parsed"))
    parsed = spark.read.parquet(str(tmp_path / "parsed"))
    parsed = parsed.withColumn("amount", F.when(F.col("transaction_id") == "7", F.lit(1e17)).otherwise(F.col("amount")))
    good, bad = quarantine(parsed)
    assert good.count() + bad.count() == parsed.count()
    make_batch_writer(str(tmp_path / "lake"), str(tmp_path / "flagged"), quarantine_root=str(tmp_path / "aside"))(parsed, 0)
    aside = spark.read.parquet(str(tmp_path / "aside"))
    reasons = {r.reason: r["count"] for r in aside.groupBy("reason").count().collect()}
    assert reasons["amount"] == 1 and reasons["corrupt"] > 0
    assert aside.where("reason = 'corrupt' and message is null").count() == 0
    assert spark.read.parquet(str(tmp_path / "lake")).count() == good.count()


@pytest.mark.parametrize("records", [1, 2, 7, 10_000])
def test_alerts_do_not_depend_on_arrow_batches(spark, tmp_path, records):
    from vigil.streaming.alerts import rapid_fire_alerts
    rnd = random.Random(3)
    rows = [(f"t{i:03d}", rnd.choice(["x", "y"]), at(rnd.randrange(900))) for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id string, nameOrig string, event_time timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    want = [i for n, (i, k, t) in enumerate(ordered)
            if sum(k2 == k and t - t2 <= dt.timedelta(seconds=60) for _, k2, t2 in ordered[:n]) + 1 >= 3]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark("event_time", "10 minutes")
        q = (rapid_fire_alerts(stream, window_seconds=60).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.transaction_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(want)


def test_reconciling_an_empty_lake_gives_zeros(spark, tmp_path):
    from vigil.plans.ingest import reconcile_days
    from vigil.sinks.upsert import read_table
    reconcile_days(spark, str(tmp_path / "no-lake"), str(tmp_path / "summary"), ["2026-01-02"])
    row = read_table(spark, str(tmp_path / "summary"), DAILY_SUMMARY).first()
    assert (row.total_txns, row.flagged_count, row.top_rule) == (0, 0, None)


def test_money_sums_do_not_depend_on_the_order_of_rows(spark):
    import datetime as dt
    import functools
    import math
    import operator
    import random
    from decimal import Decimal

    from vigil.operators.daily import daily_summary
    from vigil.operators.stats import account_stats
    rng = random.Random(3)
    amounts = [rng.randrange(1, 10 ** 9) / 100 for _ in range(3000)] + [1e15 + 0.5, -1e15 - 0.5, 0.1, 0.2, 0.3]
    want = float(sum(Decimal(repr(a)) for a in amounts))
    plain = [functools.reduce(operator.add, sorted(amounts, reverse=r)) for r in (False, True)]
    assert want not in plain  # sums of doubles do depend on it
    for parts, order in ((1, False), (7, True)):
        rows = [("a", x, "2024-01-01", True, "r") for x in sorted(amounts, reverse=order)]
        rows += [("n", float("nan"), None, False, None), ("n", 1.0, None, False, None), ("i", float("inf"), None, False, None),
                 ("i", 2.5, None, False, None), ("b", 1e23, None, False, None), ("b", 1.0, None, False, None), ("z", None, None, False, None)]
        df = spark.createDataFrame(rows, "nameOrig string, amount double, dt string, is_fraud_detected boolean, rule_name string").repartition(parts)
        got = {r.nameOrig: r.total_amount_5m for r in account_stats(df).collect()}
        assert got["a"] == want and got["z"] is None
        assert math.isnan(got["n"]) and got["i"] == float("inf") and got["b"] == 1e23 + 1.0
        day = daily_summary(df).first()
        assert day.summary_date == dt.date(2024, 1, 1)
        assert float(day.total_amount) == float(day.flagged_amount) == round(want, 2)
