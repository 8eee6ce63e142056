"""Scoring: enrich -> rules -> flags (the W5 body, usable on batch and stream).

`score` is a pure DataFrame -> DataFrame function.  The streaming job calls
it inside `foreachBatch` with `batch_cols=()` (statistics per micro-batch,
as coded in the reference); a lake replay calls it with `batch_cols=("dt",)`
so each day stands in for a micro-batch, or with precomputed `stats`.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import RuleSet, default_rules, geo_flag
from vigil.operators.stats import account_stats, attach_stats


def with_dt(df: DataFrame, event_time: str = "event_time") -> DataFrame:
    """`dt` partition string in the session zone (UTC)."""
    if "dt" in df.columns:
        return df
    return df.withColumn("dt", F.date_format(event_time, "yyyy-MM-dd"))


def score(df: DataFrame, rules: RuleSet | None = None, batch_cols: Sequence[str] = ("dt",),
          stats: DataFrame | None = None, account: str = "nameOrig",
          hot_rows: int | None = None) -> DataFrame:
    """Attach statistics (A1/J1), derive geo_flag (P7), apply the rules.

    Output: input columns + tx_count_5m, total_amount_5m, max_amount_5m,
    geo_flag, rule_name, is_fraud_detected, dt.  Everything is a column
    expression, so the plan is scan -> partial agg -> shuffle -> join ->
    one codegen'd projection.
    """
    rules = rules or default_rules()
    df = with_dt(df)
    if stats is None:
        stats = account_stats(df, account=account, batch_cols=batch_cols)
    kw = {"hot_rows": hot_rows} if hot_rows else {}
    enriched = attach_stats(df, stats, account=account, batch_cols=batch_cols, **kw)
    if "geo_flag" not in enriched.columns:
        enriched = enriched.withColumn("geo_flag", geo_flag(F.col("anomaly_type")))
    return (enriched
            .withColumn("rule_name", rules.first_match())
            .withColumn("is_fraud_detected", F.col("rule_name").isNotNull()))


def score_trailing(df: DataFrame, rules: RuleSet | None = None, seconds: int = 300,
                   bucket_seconds: int = 3600, account: str = "nameOrig") -> DataFrame:
    """Intent scoring: the statistics are a true trailing window of event
    time (X1) instead of whatever one micro-batch happens to hold, so the
    result does not depend on how data was cut into batches (replay = stream).
    Skew-safe through the bucketed trailing window; no join back needed."""
    from vigil.operators.sequence import trailing_window
    rules = rules or default_rules()
    t = trailing_window(with_dt(df), account, "event_time", "amount", seconds, bucket_seconds, prefix="_tw_")
    t = (t.withColumnRenamed("_tw_count", "tx_count_5m").withColumnRenamed("_tw_sum", "total_amount_5m")
          .withColumnRenamed("_tw_max", "max_amount_5m"))
    if "geo_flag" not in t.columns:
        t = t.withColumn("geo_flag", geo_flag(F.col("anomaly_type")))
    return (t.withColumn("rule_name", rules.first_match())
             .withColumn("is_fraud_detected", F.col("rule_name").isNotNull()))


def flagged(scored: DataFrame) -> DataFrame:
    """flagged rows only (a null flag is excluded)."""
    return scored.where(F.col("is_fraud_detected"))


def to_serving(scored: DataFrame, detected_at=None) -> DataFrame:
    """P5: stream column names -> serving-table names (flagged_transactions).

    `detected_at` (a Column) fills the audit column; by default the table's
    default (`current_timestamp()`) applies when the frame is conformed.
    """
    extra = [detected_at.alias("detected_at")] if detected_at is not None else []
    return scored.select(
        "transaction_id", "event_time",
        F.col("type").alias("tx_type"),
        "amount",
        F.col("nameOrig").alias("origin_account"),
        F.col("nameDest").alias("dest_account"),
        "rule_name", "tx_count_5m", "total_amount_5m", "max_amount_5m",
        F.col("geo_flag").alias("geo_impossible"),
        *extra,
    )


def to_raw_mirror(scored: DataFrame) -> DataFrame:
    """Stream column names -> the 14-column raw mirror."""
    return scored.select(
        "transaction_id", "event_time", "ingestion_time",
        F.col("type").alias("tx_type"), "amount",
        F.col("nameOrig").alias("origin_account"),
        F.col("oldbalanceOrg").alias("old_balance_orig"),
        F.col("newbalanceOrig").alias("new_balance_orig"),
        F.col("nameDest").alias("dest_account"),
        F.col("oldbalanceDest").alias("old_balance_dest"),
        F.col("newbalanceDest").alias("new_balance_dest"),
        "location",
        F.col("isFraud").alias("is_fraud"),
        "anomaly_type",
    )


def rule_matches(df: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Every rule that fires for a row (array, priority order)."""
    rules = rules or default_rules()
    return df.withColumn("matched_rules", rules.all_matches())
