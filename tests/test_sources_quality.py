"""Sources (parse, CSV, payloads, seed), the quality suite with planted faults, daily summary."""

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from vigil.operators.daily import daily_summary
from vigil.operators.quality import Check, run_checks
from vigil.sources.loans import read_loans_csv
from vigil.sources.rates import read_rate_files
from vigil.sources.seed import fallback_profile, profile_or_fallback, read_seed_csv
from vigil.sources.transactions import encode_events, parse_transactions, split_corrupt

GOOD = {"transaction_id": "a1", "ingestion_timestamp": "2026-07-19T10:00:05+00:00", "step": 1,
        "timestamp": "2026-07-19T02:00:00", "type": "TRANSFER", "amount": 500000.0, "nameOrig": "C1",
        "oldbalanceOrg": 1.0, "newbalanceOrig": 0.0, "nameDest": "C2", "oldbalanceDest": 0.0,
        "newbalanceDest": 1.0, "location": "LK", "isFraud": 1, "isFlaggedFraud": 0,
        "anomaly_type": "large_amount"}


def test_parse_good_broken_wrong_type_bad_time(spark):
    msgs = [json.dumps(GOOD),
            '{"transaction_id": "a2", "amount": ',                        # broken JSON (N5)
            json.dumps({**GOOD, "transaction_id": "a3", "amount": "lots"}),  # wrong type
            json.dumps({**GOOD, "transaction_id": "a4", "timestamp": "yesterday"})]  # bad time (N20)
    raw = spark.createDataFrame([(m.encode(),) for m in msgs], "value binary")
    p = {r.transaction_id: r for r in parse_transactions(raw).collect()}
    assert p["a1"].event_time == dt.datetime(2026, 7, 19, 2, 0) and p["a1"].amount == 500000.0
    assert p["a1"].ingestion_time == dt.datetime(2026, 7, 19, 10, 0, 5)
    assert p["a4"].event_time is None and p["a4"]._corrupt_record is None
    good, bad = split_corrupt(parse_transactions(raw))
    assert good.count() + bad.count() == 4
    assert bad.where(F.col("_corrupt_record").contains('"a2"')).count() == 1


def test_encode_round_trip(spark):
    raw = spark.createDataFrame([(json.dumps(GOOD).encode(),)], "value binary")
    parsed = parse_transactions(raw).drop("_corrupt_record")
    wire = parsed.select(
        "transaction_id", F.date_format("ingestion_time", "yyyy-MM-dd'T'HH:mm:ssxxx").alias("ingestion_timestamp"),
        "step", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        *[c for c in parsed.columns if c not in ("transaction_id", "step", "event_time", "ingestion_time")])
    again = parse_transactions(encode_events(wire)).drop("_corrupt_record")
    assert again.collect() == parsed.collect()


LOANS_CSV = """loan_id,person_age,person_income,loan_amnt,loan_int_rate,loan_grade,loan_intent,loan_status,cb_person_default_on_file
L1,22,59000,35000,16.02,d,PERSONAL,1,Y
L2,abc,9600,1000,11.14,B,EDUCATION,0,N
L3,25,,5500,12.87,C,MEDICAL,NA,N
,23,65500,35000,15.23,C,MEDICAL,1,N
NA,23,65500,35000,15.23,C,MEDICAL,1,N
L1,23,59000,36000,16.02,D,PERSONAL,,Y
"""


def test_loans_csv(spark, tmp_path):
    p = tmp_path / "loans.csv"
    p.write_text(LOANS_CSV)
    got = read_loans_csv(spark, str(p)).collect()
    assert [r.loan_id for r in got] == ["L1", "L2", "L3", "L1"]   # null and "NA" ids dropped
    assert got[0].person_age == 22 and got[0].loan_grade == "d" and got[0].loan_int_rate == 16.02
    assert got[1].person_age is None
    assert got[2].person_income is None and got[2].loan_status is None
    assert got[3].loan_status is None


def test_rate_files_with_fallback(spark, tmp_path):
    for day, body in [("2026-07-18", {"rates": {"LKR": 299.5}}), ("2026-07-19", {"rates": {}})]:
        d = tmp_path / "rates" / f"dt={day}"
        d.mkdir(parents=True)
        (d / "rates.json").write_text(json.dumps(body))
    got = {str(r.rate_date): (float(r.usd_lkr_rate), r.source_url)
           for r in read_rate_files(spark, str(tmp_path / "rates"), "https://example.invalid/latest").collect()}
    assert got == {"2026-07-18": (299.5, "https://example.invalid/latest"), "2026-07-19": (300.0, "fallback")}


def test_seed_csv_and_fallback(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,"
                 "newbalanceDest,isFraud,isFlaggedFraud\n"
                 "1,PAYMENT,9839.64,C1,170136.0,160296.36,M1,0.0,0.0,0,0\n"
                 "1,TRANSFER,181.0,C2,181.0,0.0,C3,0.0,0.0,1,0\n")
    s = read_seed_csv(spark, str(p))
    assert s.columns == ["type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
                         "newbalanceDest", "isFraud", "isFlaggedFraud"]
    assert s.count() == 2
    assert fallback_profile(spark).count() == 5
    assert profile_or_fallback(spark, str(tmp_path / "missing.parquet")).count() == 5
    s.write.parquet(str(tmp_path / "seed.parquet"))
    prof = {r.type: r for r in profile_or_fallback(spark, str(tmp_path / "seed.parquet")).collect()}
    assert prof["PAYMENT"].weight == 0.5 and prof["TRANSFER"].amount_mean == 181.0


def test_quality_suite_planted_violations(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 0, "a"), (1, 1, None), (3, 2, "b"), (None, 2, "b"), (4, 5, "c")],
                                  "pid int, status int, name string")
    checks = [Check("child", "name", "not_null"), Check("child", "pid", "unique"),
              Check("child", "status", "accepted_values", (0, 1)),
              Check("child", "pid", "relationships", to="parent", field="id"),
              Check("parent", "id", "unique"), Check("parent", "id", "not_null")]
    got = {(r.table_name, r.column_name, r.test_name): r.failures
           for r in run_checks({"parent": parent, "child": child}, checks).collect()}
    assert got == {("child", "name", "not_null"): 1, ("child", "pid", "unique"): 1,
                   ("child", "status", "accepted_values"): 2, ("child", "pid", "relationships"): 2,
                   ("parent", "id", "unique"): 0, ("parent", "id", "not_null"): 0}


def test_unique_on_fused_and_grouped_paths(spark):
    """Keys with an exact text form share one grouping; a double column keeps
    its own (-0.0 and 0.0 are one value, as Spark groups them)."""
    t = spark.createDataFrame([("x", 1.0, 7), ("x", 0.0, 7), ("y", -0.0, 8), ("y", 2.0, None), (None, 3.0, None)],
                              "k string, d double, n int")
    checks = [Check("t", "k", "unique"), Check("t", "d", "unique"), Check("t", "n", "unique")]
    got = {r.column_name: r.failures for r in run_checks({"t": t}, checks).collect()}
    assert got == {"k": 2, "d": 1, "n": 1}


def test_relationships_fused_and_anti_join_agree(spark):
    """Same-typed keys take the fused grouping, mixed types the anti-join;
    a hot orphan key counts every one of its rows."""
    from pyspark.sql import functions as F
    child = spark.range(1000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5))
                                     .cast("int").alias("pid"))
    parent = spark.createDataFrame([(0,), (1,), (2,)], "id int")
    want = child.where(~F.col("pid").isin(0, 1, 2)).count()
    for p in (parent, parent.select(F.col("id").cast("bigint").alias("id"))):
        got = run_checks({"child": child, "parent": p},
                         [Check("child", "pid", "relationships", to="parent", field="id")]).first()
        assert got.failures == want


def test_daily_summary_edges(spark):
    rows = [("2026-07-19", 10.0, True, "odd_hour"), ("2026-07-19", math.nan, True, "rapid_fire"),
            ("2026-07-19", 5.0, False, None), ("2026-07-19", 1.0, True, "rapid_fire"),
            ("2026-07-19", 2.0, True, "odd_hour"),              # tie -> smallest name
            ("2026-07-20", 7.0, False, None),                   # no flags -> 0 and null rule
            (None, 3.0, True, "odd_hour")]                      # no date -> no day
    s = spark.createDataFrame(rows, "dt string, amount double, is_fraud_detected boolean, rule_name string")
    dates = spark.createDataFrame([(dt.date(2026, 7, d),) for d in (18, 19, 20)], "summary_date date")
    got = {r.summary_date.day: r for r in daily_summary(s, dates).collect()}
    assert (got[18].total_txns, got[18].flagged_count, float(got[18].total_amount), got[18].top_rule) == (0, 0, 0.0, None)
    assert got[19].total_txns == 5 and got[19].flagged_count == 4
    assert float(got[19].total_amount) == 18.0 and float(got[19].flagged_amount) == 13.0
    assert got[19].top_rule == "odd_hour"
    assert float(got[20].flagged_amount) == 0.0 and got[20].top_rule is None
