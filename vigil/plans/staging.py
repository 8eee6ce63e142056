"""Staging views over the serving tables.

Each function is the 1:1 clean-up a warehouse staging model performs; the
result is lazy, so "materialised as a view" (K9) is simply not writing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.money import pct


def stg_flagged(flagged: DataFrame) -> DataFrame:
    """Pass-through + event_date; the four context columns default to 0."""
    return flagged.select(
        "transaction_id", "origin_account", "dest_account",
        "event_time",
        F.to_date("event_time").alias("event_date"),
        "detected_at", "tx_type", "amount", "rule_name",
        F.coalesce("tx_count_5m", F.lit(0)).alias("tx_count_5m"),
        F.coalesce("total_amount_5m", F.lit(0).cast("decimal(18,2)")).alias("total_amount_5m"),
        F.coalesce("max_amount_5m", F.lit(0).cast("decimal(18,2)")).alias("max_amount_5m"),
        F.coalesce("geo_impossible", F.lit(0).cast("short")).alias("geo_impossible"),
    )


def stg_daily_summary(daily: DataFrame) -> DataFrame:
    """Amounts default to 0; fraud_rate_pct = 0 when there were no rows."""
    rate = F.when(F.col("total_txns") == 0, F.lit(0).cast("decimal(11,2)")).otherwise(
        pct(F.col("flagged_count"), F.col("total_txns")))
    return daily.select(
        "summary_date", "total_txns", "flagged_count",
        F.coalesce("total_amount", F.lit(0).cast("decimal(20,2)")).alias("total_amount"),
        F.coalesce("flagged_amount", F.lit(0).cast("decimal(20,2)")).alias("flagged_amount"),
        "top_rule", "computed_at",
        rate.alias("fraud_rate_pct"),
    )


def stg_loans(loans: DataFrame) -> DataFrame:
    """Numerics default to 0, grade upper-cased, status label (null -> Performing)."""
    return loans.select(
        "loan_id",
        F.coalesce("person_age", F.lit(0).cast("short")).alias("person_age"),
        F.coalesce("person_income", F.lit(0).cast("decimal(14,2)")).alias("person_income"),
        F.coalesce("loan_amnt", F.lit(0).cast("decimal(14,2)")).alias("loan_amnt"),
        F.coalesce("loan_int_rate", F.lit(0).cast("decimal(6,3)")).alias("loan_int_rate"),
        F.upper("loan_grade").alias("loan_grade"),
        "loan_intent", "loan_status",
        F.when(F.col("loan_status") == 1, "Default").otherwise("Performing").alias("loan_status_label"),
        "cb_person_default_on_file", "loaded_at",
    )


def stg_rates(rates: DataFrame) -> DataFrame:
    """Pass-through."""
    return rates.select("rate_date", "usd_lkr_rate", "source_url", "loaded_at")
