"""Dashboard queries over the marts.

All of them aggregate before anything small is joined or ordered, so the
only wide work is the scan and a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.calendar import calendar_columns
from vigil.functions.money import pct
from vigil.functions.rules import describe_rule
from vigil.operators.sequence import previous_value


def flags_per_day(fact: DataFrame) -> DataFrame:
    """B1: flagged events per calendar day.

    `dim_date` holds nothing but attributes of the date, so they are derived from the
    event date after the aggregation instead of being joined.
    """
    return (fact.groupBy(F.col("event_date").alias("full_date"))
            .agg(F.count(F.lit(1)).alias("n_flags")))


def flags_by_rule(scored: DataFrame) -> DataFrame:
    """B2 (flagship): rows per rule, with description and share of all rows.

    Rows no rule flagged form their own group (rule_name null).  The share
    needs the grand total: a window over the aggregated result, which has one
    row per rule plus one, so it is bounded by the rule set, not the data.
    """
    g = (scored.groupBy("rule_name").agg(F.count(F.lit(1)).alias("n_events"))
         .withColumn("_total", F.sum("n_events").over(Window.partitionBy(F.lit(1)))))
    return g.select(
        "rule_name",
        describe_rule(F.col("rule_name")).alias("rule_description"),
        "n_events",
        pct(F.col("n_events"), F.col("_total")).alias("share_pct"),
    )


def top_risk_accounts(d_account: DataFrame, k: int = 10) -> DataFrame:
    """The k accounts with most flags (ties: amount, then id).

    `orderBy().limit()` plans as TakeOrderedAndProject: each task keeps its
    own top k, so only k rows per task reach the final merge.
    """
    return (d_account.orderBy(F.desc("total_flags"), F.desc("total_flagged_amount"),
                              F.asc_nulls_last("account_id"))
            .limit(k)
            .select("account_id", "total_flags", "total_flagged_amount",
                    "most_common_rule", "distinct_rules_triggered"))


def default_rate_by_grade(mart: DataFrame) -> DataFrame:
    """Default rate per grade, re-aggregated from sums (not an average of %)."""
    return (mart.groupBy("loan_grade")
            .agg(F.sum("total_loans").alias("total_loans"),
                 F.sum("total_defaults").alias("total_defaults"))
            .select("loan_grade", "total_loans", "total_defaults",
                    pct(F.col("total_defaults"), F.col("total_loans")).alias("default_rate_pct")))


def rate_trend(rates: DataFrame) -> DataFrame:
    """Rates by date with the change from the previous available day."""
    prev = previous_value(rates.withColumn("_all", F.lit(1)), key="_all", order="rate_date",
                          values=["usd_lkr_rate"], bucket=F.year("rate_date"))
    return prev.select(
        "rate_date", "usd_lkr_rate",
        F.col("prev_usd_lkr_rate").alias("prev_rate"),
        (F.col("usd_lkr_rate") - F.col("prev_usd_lkr_rate")).cast("decimal(11,4)").alias("rate_change"))


def weekend_vs_weekday(fact: DataFrame) -> DataFrame:
    """Flags by month, weekend vs weekday (calendar attributes as in `flags_per_day`)."""
    days = fact.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    return (days.select("n", *calendar_columns(F.col("event_date")))
            .groupBy("year_month", "is_weekend").agg(F.sum("n").alias("n_flags")))
