"""Batch jobs: the daily reconciliation and the two reference-data loads (§3.2).

Each job is a handful of library calls; each is idempotent (re-running a
day or a file produces the same table), so a scheduler may retry freely.
"""

from __future__ import annotations

import datetime as dt
from typing import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from vigil.operators.daily import daily_summary
from vigil.schemas import DAILY_SUMMARY, LOANS, RATES
from vigil.sinks.lake import overwrite_partitions, read_lake, write_if_absent
from vigil.sinks.upsert import upsert
from vigil.sources.loans import read_loans_csv
from vigil.sources.rates import read_rate_files

LOAN_UPDATE_COLUMNS = ["person_income", "loan_amnt", "loan_int_rate", "loan_grade", "loan_intent",
                       "loan_status"]


def yesterday_utc() -> str:
    return (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date().isoformat()


def reconcile_days(spark: SparkSession, lake_root: str, table_root: str,
                   days: Iterable[str] | None = None, now: Column | None = None) -> str:
    """S3 + A2 + K3: summarise the given days of the lake (default: yesterday,
    UTC) and upsert one row per day; days without files get a row of zeros."""
    days = list(days or [yesterday_utc()])
    lake = read_lake(spark, lake_root, days)  # nothing written yet: days of zeros (N7)
    dates = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "summary_date date")
    return upsert(spark, table_root, daily_summary(lake, dates, now=now), DAILY_SUMMARY, now=now)


def load_loans(spark: SparkSession, csv_path: str, snapshot_path: str, table_root: str,
               order: str | None = None, trim: bool = False, now: Column | None = None) -> str:
    """S4 + K6 + K4: read the CSV, keep a Parquet snapshot if none exists yet,
    upsert by loan_id changing only the six updatable columns (N17).  Rows
    of one load are applied in file order (N18): files by name, then by position.  Spark reads
    large splits first, so the row's number counts within its split only."""
    loans = read_loans_csv(spark, csv_path, trim, position="_pos")
    if order is not None:
        loans = loans.withColumn("_pos", F.col(order))
    write_if_absent(loans.drop("_pos"), snapshot_path)
    return upsert(spark, table_root, loans, LOANS, update_cols=LOAN_UPDATE_COLUMNS, order="_pos", now=now)


def load_rates(spark: SparkSession, payload_root: str, lake_root: str, table_root: str,
               source_url: str, now: Column | None = None) -> str:
    """S6 + K7 + K5: parse landed payloads, replace their `dt` partitions in
    the reference lake, upsert by rate_date."""
    rates = read_rate_files(spark, payload_root, source_url)
    overwrite_partitions(rates.withColumn("dt", F.date_format("rate_date", "yyyy-MM-dd")), lake_root)
    return upsert(spark, table_root, rates, RATES, now=now)
