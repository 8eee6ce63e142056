"""Per-account statistics attached to every row (A1 + J1).

The reference computes, per micro-batch, count / sum / max of the amount by
origin account and left-joins them back.  We keep that shape on purpose:
`groupBy().agg()` is a partial (map-side) + final hash aggregate, so an
account holding a third of all rows is pre-reduced in every input task
before the shuffle; the join back salts hot groups so no join task receives
more than about `hot_rows` rows of one group.  The alternative (`count(*) over (partition by
account)`) needs one shuffle less but puts every row of a hot account into
one task, which does not survive skew.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.money import exact_sum
from vigil.operators.joins import HOT_KEYS, salt_of

STAT_COLUMNS = ("tx_count_5m", "total_amount_5m", "max_amount_5m")


def account_stats(df: DataFrame, account: str = "nameOrig", amount: str = "amount",
                  batch_cols: Sequence[str] = ()) -> DataFrame:
    """A1: one row per (account, *batch_cols) with count, sum and max amount.

    A null account forms its own group here (as `groupBy` does); `attach_stats`
    then fails to match it, which is the reference's behaviour (N2).  Floating-point
    amounts are added exactly, so the sum does not depend on the order of rows.
    """
    floating = df.schema[amount].dataType.typeName() in ("double", "float")
    return (df.groupBy(account, *batch_cols)
            .agg(F.count(F.lit(1)).alias("tx_count_5m"),
                 (exact_sum(F.col(amount).cast("double")) if floating else F.sum(amount)).alias("total_amount_5m"),
                 F.max(amount).alias("max_amount_5m")))


HOT_ROWS = 1_000_000


def attach_stats(df: DataFrame, stats: DataFrame, account: str = "nameOrig",
                 batch_cols: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left equi-join of the statistics onto the rows.

    The account key uses plain equality (null never matches, N2); batch
    columns use null-safe equality so rows without an event time still meet
    their own batch's statistics.

    Hot groups are salted.  AQE cannot split this join's skew (its build side
    is an aggregate, not a bare shuffle), so a group with more than
    `hot_rows` rows is spread over ceil(count / hot_rows) salts: its rows get
    a salt from a hash of the row, its single statistics row is replicated once
    per salt, and the equi-join includes the salt.  Which groups are hot comes
    from the statistics themselves, as a broadcast list of at most HOT_KEYS
    groups.  Rows with a null account, which match nothing, are spread too.
    """
    bc = list(batch_cols)
    s = stats.select(F.col(account).alias("_s_acct"), *[F.col(b).alias(f"_s_{b}") for b in bc],
                     *STAT_COLUMNS)
    n_salt = F.ceil(F.col("tx_count_5m") / F.lit(hot_rows)).cast("int")
    hot = (s.where(n_salt > 1).orderBy(F.desc("tx_count_5m")).limit(HOT_KEYS)
           .select(F.col("_s_acct").alias("_h_acct"), *[F.col(f"_s_{b}").alias(f"_h_{b}") for b in bc],
                   n_salt.alias("_n_salt")))
    hcond = F.col(account) == F.col("_h_acct")
    for b in bc:
        hcond = hcond & F.col(b).eqNullSafe(F.col(f"_h_{b}"))
    rows = (df.join(F.broadcast(hot), hcond, "left")
              .withColumn("_salt", salt_of(df, F.col(account), F.col("_n_salt")))
              .drop("_h_acct", *[f"_h_{b}" for b in bc], "_n_salt"))
    sx = s.withColumn("_s_salt", F.explode(F.sequence(F.lit(0), F.greatest(n_salt, F.lit(1)) - 1)))
    cond = (F.col(account) == F.col("_s_acct")) & (F.col("_salt") == F.col("_s_salt"))
    for b in bc:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_s_{b}"))
    joined = rows.join(sx, cond, "left")
    return joined.drop("_s_acct", "_salt", "_s_salt", *[f"_s_{b}" for b in bc])
