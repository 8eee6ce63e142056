"""Batch jobs end to end: reconciliation, loans load, rates load; each re-run is a no-op."""

import datetime as dt
import json

from pyspark.sql import functions as F

from vigil.plans.ingest import load_loans, load_rates, reconcile_days
from vigil.schemas import DAILY_SUMMARY, LOANS, RATES
from vigil.sinks.lake import as_table, as_view, write_lake_batch, write_snapshot
from vigil.sinks.upsert import read_table

def now():
    return F.lit(dt.datetime(2026, 7, 20, 6, 0)).cast("timestamp")


def test_reconcile_days(spark, tmp_path):
    lake, table = str(tmp_path / "lake"), str(tmp_path / "summary")
    scored = spark.createDataFrame(
        [("t1", "2026-07-19", 100.0, True, "odd_hour"), ("t2", "2026-07-19", 50.0, False, None),
         ("t3", "2026-07-18", 7.0, True, "rapid_fire")],
        "transaction_id string, dt string, amount double, is_fraud_detected boolean, rule_name string")
    write_lake_batch(scored, lake, 0)
    reconcile_days(spark, lake, table, ["2026-07-19", "2026-07-17"], now=now())
    reconcile_days(spark, lake, table, ["2026-07-19"], now=now())        # re-run of a date
    got = {str(r.summary_date): (r.total_txns, r.flagged_count, float(r.total_amount), r.top_rule)
           for r in read_table(spark, table, DAILY_SUMMARY).collect()}
    assert got == {"2026-07-19": (2, 1, 150.0, "odd_hour"), "2026-07-17": (0, 0, 0.0, None)}


def test_load_loans_twice(spark, tmp_path):
    csv = tmp_path / "loans.csv"
    csv.write_text("loan_id,person_age,person_income,loan_amnt,loan_int_rate,loan_grade,loan_intent,"
                   "loan_status,cb_person_default_on_file\n"
                   "L1,22,59000,35000,16.02,D,PERSONAL,1,Y\nL2,21,9600,1000,11.14,B,EDUCATION,0,N\n")
    snap, table = str(tmp_path / "snap"), str(tmp_path / "loans_t")
    load_loans(spark, str(csv), snap, table, now=now())
    csv.write_text("loan_id,person_age,person_income,loan_amnt,loan_int_rate,loan_grade,loan_intent,"
                   "loan_status,cb_person_default_on_file\n"
                   "L1,30,59000,36000,16.02,D,PERSONAL,1,N\nL1,31,59000,37000,16.02,D,PERSONAL,0,N\n")
    load_loans(spark, str(csv), snap, table, now=now())
    got = {r.loan_id: r for r in read_table(spark, table, LOANS).collect()}
    assert got["L1"].person_age == 22 and got["L1"].cb_person_default_on_file == "Y"   # kept (N17)
    assert float(got["L1"].loan_amnt) == 37000.0 and got["L1"].loan_status == 0         # last wins (N18)
    assert spark.read.parquet(snap).count() == 2                                          # K6: first file kept


def test_load_rates(spark, tmp_path):
    for day, rate in [("2026-07-18", 299.5), ("2026-07-19", 301.0)]:
        d = tmp_path / "payloads" / f"dt={day}"
        d.mkdir(parents=True)
        (d / "p.json").write_text(json.dumps({"rates": {"LKR": rate}}))
    lake, table = str(tmp_path / "rate_lake"), str(tmp_path / "rates_t")
    for _ in range(2):
        load_rates(spark, str(tmp_path / "payloads"), lake, table, "src", now=now())
    got = {str(r.rate_date): float(r.usd_lkr_rate) for r in read_table(spark, table, RATES).collect()}
    assert got == {"2026-07-18": 299.5, "2026-07-19": 301.0}
    assert spark.read.parquet(lake).count() == 2


def test_view_table_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    as_view(df, "vigil_test_view")
    assert spark.sql("select count(*) from vigil_test_view").first()[0] == 1
    as_table(df, "ignored", path=str(tmp_path / "mart"))
    write_snapshot(df, str(tmp_path / "snap"))
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 1
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 1


def test_compact_flagged_and_build_warehouse(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from vigil.operators.daily import daily_summary, date_span
    from vigil.operators.score import flagged, score, to_serving
    from vigil.plans.warehouse import build_warehouse, compact_flagged
    from vigil.schemas import FLAGGED
    from vigil.sinks.lake import write_flagged_batch
    from vigil.sinks.upsert import upsert
    from vigil.sources import derived
    scored = score(derived.transactions(spark, SF_SMALL), batch_cols=("dt",))
    serving = to_serving(flagged(scored), detected_at=F.col("ingestion_time"))
    fb, ft = str(tmp_path / "fb"), str(tmp_path / "ft")
    write_flagged_batch(serving.where("event_time < '2024-01-15'"), fb, 0)   # early rows first ...
    write_flagged_batch(serving, fb, 1)                                      # ... then all, overlapping
    compact_flagged(spark, fb, ft)
    compact_flagged(spark, fb, ft)                       # idempotent
    t = read_table(spark, ft, FLAGGED)
    assert t.count() == serving.count() == t.select("transaction_id").distinct().count()
    roots = {k: str(tmp_path / k) for k in ("summary", "loans", "rates", "out")}
    upsert(spark, roots["summary"], daily_summary(scored, date_span(scored)), DAILY_SUMMARY, now=now())
    upsert(spark, roots["loans"], derived.loans(spark, SF_SMALL), LOANS, now=now())
    upsert(spark, roots["rates"], derived.rates(spark, SF_SMALL), RATES, now=now())
    out = build_warehouse(spark, ft, roots["summary"], roots["loans"], roots["rates"], roots["out"])
    res = {(r.table_name, r.column_name, r.test_name): r.failures for r in out["test_results"].collect()}
    assert len(res) == 45 and sum(res.values()) == 0
    assert out["fact_fraud_events"].count() == serving.count()


def test_cli_reconcile(spark, tmp_path):
    from vigil.__main__ import main
    lake, table = str(tmp_path / "lake"), str(tmp_path / "summary")
    s = spark.createDataFrame([("t1", "2026-07-19", 1.0, True, "odd_hour")],
                              "transaction_id string, dt string, amount double, is_fraud_detected boolean, "
                              "rule_name string")
    write_lake_batch(s, lake, 0)
    main(["reconcile", "--lake", lake, "--table", table, "--day", "2026-07-19"])
    assert read_table(spark, table, DAILY_SUMMARY).first().flagged_count == 1
