"""Rule cases (thresholds, hours, priority, nulls, NaN) as one table-driven test."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.rules import (RuleContext, amount_over_history, default_rules, describe_rule,
                                   geo_flag, travel_within)

SCHEMA = T.StructType([
    T.StructField("case", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("tx_count_5m", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("geo_flag", T.IntegerType()),
    T.StructField("expect", T.StringType()),
])


def ts(h, m=0):
    return dt.datetime(2026, 7, 19, h, m, tzinfo=dt.timezone.utc)


CASES = [
    # thresholds
    ("amount at threshold", 500000.0, 1, ts(12), 0, "large_amount"),
    ("amount above", 500000.01, 1, ts(12), 0, "large_amount"),
    ("amount just below", 499999.99, 1, ts(12), 0, None),
    ("count 2", 10.0, 2, ts(12), 0, None),
    ("count 3", 10.0, 3, ts(12), 0, "rapid_fire"),
    ("count 10", 10.0, 10, ts(12), 0, "rapid_fire"),
    # hours: 0, 3, 4 fire; 5, 12 do not
    ("hour 0", 10.0, 1, ts(0), 0, "odd_hour"),
    ("hour 3", 10.0, 1, ts(3, 59), 0, "odd_hour"),
    ("hour 4", 10.0, 1, ts(4, 59), 0, "odd_hour"),
    ("hour 5", 10.0, 1, ts(5), 0, None),
    ("hour 12", 10.0, 1, ts(12), 0, None),
    # priority: geo > large > rapid > odd
    ("geo with large amount", 900000.0, 1, ts(12), 1, "geo_impossible"),
    ("large with 10 events", 900000.0, 10, ts(12), 0, "large_amount"),
    ("5 events at 02:00", 10.0, 5, ts(2), 0, "rapid_fire"),
    ("everything", 900000.0, 10, ts(2), 1, "geo_impossible"),
    # null handling (N1): null amount -> 0, null count -> 0, null time -> hour 12, null geo -> 0
    ("null amount", None, 1, ts(12), 0, None),
    ("null count", 10.0, None, ts(12), 0, None),
    ("null time", 10.0, 1, None, 0, None),
    ("null geo", 10.0, 1, ts(12), None, None),
    ("all null", None, None, None, None, None),
    # NaN (N4): never large, unlike Spark's NaN >= t
    ("NaN amount", math.nan, 1, ts(12), 0, None),
    ("NaN amount odd hour", math.nan, 1, ts(1), 0, "odd_hour"),
    ("infinite amount", math.inf, 1, ts(12), 0, "large_amount"),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    r = default_rules()
    return {row["case"]: row for row in df.select(
        "case", "expect", r.first_match().alias("got"),
        F.array_join(r.all_matches(), ",").alias("all")).collect()}


@pytest.mark.parametrize("case", [c[0] for c in CASES])
def test_first_match(scored, case):
    row = scored[case]
    assert row["got"] == row["expect"], case


def test_all_matches_keep_priority_order(scored):
    assert scored["everything"]["all"] == "geo_impossible,large_amount,rapid_fire,odd_hour"
    assert scored["all null"]["all"] == ""


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame([(100.0, 1, ts(12), 0)], "amount double, tx_count_5m long, event_time timestamp, geo_flag int")
    r = default_rules(large_amount=50.0)
    assert df.select(r.first_match()).first()[0] == "large_amount"


def test_geo_flag_null_when_label_null(spark):
    df = spark.createDataFrame([("geo_impossible",), ("rapid_fire",), (None,)], "a string")
    assert [r[0] for r in df.select(geo_flag(F.col("a"))).collect()] == [1, 0, None]


def test_describe_rule_fallback(spark):
    df = spark.createDataFrame([("rapid_fire",), ("new_rule",), ("odd_hour",), (None,)], "r string")
    got = [r[0] for r in df.select(describe_rule(F.col("r"))).collect()]
    assert got[0].startswith("Multiple transactions")
    assert got[1] == "New Rule"
    assert got[2].startswith("Transaction occurred between midnight")
    assert got[3] is None


def test_intent_rules(spark):
    df = spark.createDataFrame(
        [(1100.0, 1, 100.0, ts(12), ts(12) - dt.timedelta(seconds=30), "LK", "US"),
         (900.0, 1, 100.0, ts(12), ts(12) - dt.timedelta(seconds=61), "LK", "US"),
         (900.0, 0, 0.0, ts(12), None, "LK", None)],
        "amount double, prior_count long, prior_amount_sum double, event_time timestamp, "
        "prev_event_time timestamp, location string, prev_location string")
    c = RuleContext()
    got = df.select(amount_over_history(10.0)(c).alias("r5"), travel_within(60)(c).alias("r6")).collect()
    assert [(r.r5, r.r6) for r in got] == [(True, True), (False, False), (False, False)]
