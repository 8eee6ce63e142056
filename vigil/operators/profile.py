"""Distribution profiles (A8-A10), table checks (L1-L4) and detection quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.money import not_nan, pct
from vigil.operators.quantile import exact_percentiles
from vigil.operators.sequence import islands

# ---------------------------------------------------------------------------
# Log-normal parameter floors used when a profile is turned
# into sampling parameters (amount and opening balance).
# ---------------------------------------------------------------------------
AMOUNT_LOG_STD_FLOOR = 0.1
BALANCE_LOG_STD_FLOOR = 0.3
# ---------------------------------------------------------------------------


def _total(g: DataFrame, n: str):
    """Grand total of an aggregated frame as a scalar subquery: computed once
    from the (small) aggregate and inlined as a value, so no join is planned."""
    return g.agg(F.sum(n)).scalar()


def type_distribution(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Rows per type and share of all rows (percent, 2 places)."""
    g = df.groupBy(type_col).agg(F.count(F.lit(1)).alias("n"))
    return g.select(type_col, "n", pct(F.col("n"), _total(g, "n")).alias("share_pct"))


def _log_params(mean: str, std: str, floor: float) -> list:
    m = F.greatest(F.col(mean), F.lit(1.0))
    return [F.log(m).alias("log_mean"),
            F.greatest(F.log1p(F.col(std) / m), F.lit(floor)).alias("log_std")]


def amount_profile(df: DataFrame, type_col: str = "type", amount: str = "amount") -> DataFrame:
    """Per type: weight (share of rows), mean, sample std, p1, p99 of the
    amount (null and NaN skipped), and the log-normal parameters they imply."""
    a = not_nan(F.col(amount))
    prof = exact_percentiles(df, [type_col], amount, [0.01, 0.99], ["amount_min", "amount_max"],
                             extra_aggs=[F.count(F.lit(1)).alias("rows"), F.avg(a).alias("amount_mean"),
                                         F.stddev_samp(a).alias("amount_std")])
    # all rows = the sum of per-type rows; counted directly so the subquery
    # does not recompute the percentile aggregate
    total = df.agg(F.count(F.lit(1))).scalar()
    return prof.select(
        type_col,
        (F.col("rows") / total).alias("weight"),
        "amount_mean", "amount_std", "amount_min", "amount_max",
        *_log_params("amount_mean", "amount_std", AMOUNT_LOG_STD_FLOOR))


def balance_profile(df: DataFrame, balance: str = "oldbalanceOrg") -> DataFrame:
    """A10: over opening balances > 0: p5, p95, mean, sample std (one row, none without balances)."""
    pos = df.where(F.col(balance) > 0)
    prof = exact_percentiles(pos, [], balance, [0.05, 0.95], ["balance_p5", "balance_p95"],
                             extra_aggs=[F.count(F.lit(1)).alias("rows"), F.avg(balance).alias("balance_mean"),
                                         F.stddev_samp(balance).alias("balance_std")])
    return prof.where("rows > 0").select("balance_p5", "balance_p95", "balance_mean", "balance_std",
                       *_log_params("balance_mean", "balance_std", BALANCE_LOG_STD_FLOOR))


def ledger_check(df: DataFrame, tol: float = 0.005) -> DataFrame:
    """L1: rows whose balances do not move by the amount as the type says.

    CASH-IN adds to the origin, every other type subtracts; only TRANSFER
    credits the destination.  Compared in cents.
    """
    amt = F.col("amount")
    exp_orig = F.when(F.col("type") == "CASH-IN", F.col("oldbalanceOrg") + amt).otherwise(
        F.col("oldbalanceOrg") - amt)
    exp_dest = F.when(F.col("type") == "TRANSFER", F.col("oldbalanceDest") + amt).otherwise(
        F.col("oldbalanceDest"))
    d_orig = F.round(F.col("newbalanceOrig"), 2) - F.round(exp_orig, 2)
    d_dest = F.round(F.col("newbalanceDest"), 2) - F.round(exp_dest, 2)
    return (df.select("transaction_id", "type", "amount",
                      F.round(d_orig, 2).alias("orig_diff"), F.round(d_dest, 2).alias("dest_diff"))
            .where((F.abs("orig_diff") > tol) | (F.abs("dest_diff") > tol)))


def self_transfers(df: DataFrame) -> DataFrame:
    """L3: rows paid from an account to itself."""
    return df.where(F.col("nameOrig") == F.col("nameDest")).select("transaction_id", "nameOrig", "amount")


def burst_profile(df: DataFrame, max_gap_seconds: float = 2.0, min_events: int = 4,
                  account: str = "nameOrig", ts: str = "event_time",
                  bucket_seconds: int = 3600) -> DataFrame:
    """L2: runs of an account's events with every gap <= max_gap_seconds,
    reported when they hold at least `min_events` events.  `max_gap_seconds`
    of a run is its largest inner gap (the gap that opened it is excluded)."""
    isl = islands(df, account, ts, max_gap_seconds, bucket_seconds, tiebreak=["transaction_id"])
    runs = (isl.where(F.col("island").isNotNull())
            .groupBy(account, "island")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.min(ts).alias("burst_start"), F.max(ts).alias("burst_end"),
                 F.max(F.when(F.col("gap_seconds") <= max_gap_seconds, F.col("gap_seconds")))
                 .alias("max_gap_seconds")))
    return runs.where(F.col("n_events") >= min_events)


def detection_confusion(scored: DataFrame) -> DataFrame:
    """Rows per (label, rule) pair."""
    return scored.groupBy("anomaly_type", "rule_name").agg(F.count(F.lit(1)).alias("n"))


def detection_quality(scored: DataFrame) -> DataFrame:
    """Per name (label or rule): labelled rows, flagged rows, agreements,
    precision and recall in percent.  One pass: every row contributes a
    label record and a prediction record, then one aggregation by name."""
    lab, rule = F.col("anomaly_type"), F.col("rule_name")
    hit = F.coalesce(lab == rule, F.lit(False)).cast("long")
    recs = F.array(
        F.struct(lab.alias("name"), F.lit(1).cast("long").alias("a"), F.lit(0).cast("long").alias("p"),
                 hit.alias("tp")),
        F.struct(rule.alias("name"), F.lit(0).cast("long").alias("a"), F.lit(1).cast("long").alias("p"),
                 F.lit(0).cast("long").alias("tp")))
    e = scored.select(F.inline(recs)).where(F.col("name").isNotNull())
    g = e.groupBy("name").agg(F.sum("a").alias("labelled"), F.sum("p").alias("flagged"),
                              F.sum("tp").alias("true_positive"))
    return g.select("name", "labelled", "flagged", "true_positive",
                    pct(F.col("true_positive"), F.col("flagged")).alias("precision_pct"),
                    pct(F.col("true_positive"), F.col("labelled")).alias("recall_pct"))
