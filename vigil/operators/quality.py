"""Declarative data tests (Q1-Q5) run as Spark aggregations.

A `Check` names a table, a column and a test.  `run_checks` evaluates a list
of them and returns one row per check: (table_name, column_name, test_name,
failures).  Failures follow the generic test definitions: not_null counts
null rows; unique counts values that occur more than once; accepted_values
counts distinct values outside the list; relationships counts child rows
whose key has no parent.  Nulls pass unique, accepted_values and
relationships.

Q5 fusion: all not_null and accepted_values checks of a table are answered
by one aggregate scan of that table.  All unique checks whose columns have
an exact text form (strings, integers, decimals, dates, timestamps,
booleans) share one grouping: each contributes (check number, value as
text), the union is grouped once, and one aggregate counts the duplicated
values per check.  Relationships on such keys work the same way without a
join: child keys (with their row counts) and parent keys are grouped
together by (check, key), and a key is an orphan when its group has no
parent row.  Other key types keep a grouping / anti-join per check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose cast to text is one-to-one, so grouping the text groups the values.
_EXACT_TEXT = (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType,
               T.TimestampNTZType, T.BooleanType)


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str                       # not_null | unique | accepted_values | relationships
    values: tuple = ()
    to: str | None = None           # parent table for relationships
    field: str | None = None        # parent column for relationships


def _row(c: Check, failures) -> DataFrame:
    return failures.select(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                           F.lit(c.test).alias("test_name"),
                           F.col("failures").cast("long").alias("failures"))


def _fused(table: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    aggs, bad = [], []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.test == "not_null":
            aggs.append(F.count_if(col.isNull()).alias(f"_f{i}"))
        else:
            aggs.append(F.lit(None).cast("long").alias(f"_f{i}"))
            bad.append(F.when(col.isNotNull() & ~col.isin(*c.values),
                              F.struct(F.lit(i).alias("i"), col.cast("string").alias("v"))))
    wide = df.agg(*aggs)
    if bad:
        # the few rows with a value out of range are grouped, not all rows once a column
        some = (df.select(F.explode(F.array_compact(F.array(*bad))).alias("b"))
                .groupBy("b.i", "b.v").agg(F.lit(1)).groupBy("i").agg(F.count(F.lit(1)).alias("n")))
        found = some.agg(*[F.coalesce(F.max(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(f"_f{i}")
                           for i, c in enumerate(checks) if c.test != "not_null"])
        one = found.select(F.struct(*found.columns).alias("s")).scalar()
        wide = wide.withColumns({c: one.getField(c) for c in found.columns})
    # unpivot the single wide row into one row per check
    stack = F.inline(F.array(*[
        F.struct(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test_name"),
                 F.col(f"_f{i}").cast("long").alias("failures"))
        for i, c in enumerate(checks)]))
    return wide.select(stack).select(F.lit(table).alias("table_name"), "column_name", "test_name",
                                     "failures")


def _fused_unique(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Several unique checks answered by one grouping of their keys' union."""
    keys = [tables[c.table].where(F.col(c.column).isNotNull())
            .select(F.lit(i).alias("_check"), F.col(c.column).cast("string").alias("_v"))
            for i, c in enumerate(checks)]
    dup = (reduce(DataFrame.unionByName, keys).groupBy("_check", "_v")
           .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))
    wide = dup.agg(*[F.count_if(F.col("_check") == i).alias(f"_f{i}") for i in range(len(checks))])
    stack = F.inline(F.array(*[
        F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                 F.lit(c.test).alias("test_name"), F.col(f"_f{i}").cast("long").alias("failures"))
        for i, c in enumerate(checks)]))
    return wide.select(stack)


def _fused_relationships(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Several relationships checks as one grouping instead of one anti-join each.

    Child rows contribute (check, key, rows=1, parent=0), parent rows
    (check, key, 0, 1); partial aggregation folds a hot key to one row per
    task before the shuffle.  Failures = child rows whose key has no parent.
    """
    sides = []
    for i, c in enumerate(checks):
        child = tables[c.table].where(F.col(c.column).isNotNull())
        sides.append(child.select(F.lit(i).alias("_check"), F.col(c.column).cast("string").alias("_v"),
                                  F.lit(1).cast("long").alias("_rows"), F.lit(0).alias("_parent")))
        parent = tables[c.to].where(F.col(c.field).isNotNull())
        sides.append(parent.select(F.lit(i).alias("_check"), F.col(c.field).cast("string").alias("_v"),
                                   F.lit(0).cast("long").alias("_rows"), F.lit(1).alias("_parent")))
    keys = (reduce(DataFrame.unionByName, sides).groupBy("_check", "_v")
            .agg(F.sum("_rows").alias("_rows"), F.max("_parent").alias("_parent")))
    orphans = keys.where(F.col("_parent") == 0)
    wide = orphans.agg(*[F.sum(F.when(F.col("_check") == i, F.col("_rows")).otherwise(F.lit(0)))
                         .alias(f"_f{i}") for i in range(len(checks))])
    stack = F.inline(F.array(*[
        F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                 F.lit(c.test).alias("test_name"),
                 F.coalesce(F.col(f"_f{i}"), F.lit(0)).cast("long").alias("failures"))
        for i, c in enumerate(checks)]))
    return wide.select(stack)


def _exact_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _EXACT_TEXT)


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.test in ("not_null", "accepted_values"):
            by_table.setdefault(c.table, []).append(c)
    for t, cs in by_table.items():
        parts.append(_fused(t, tables[t], cs))
    exact = [c for c in checks if c.test == "unique" and _exact_text(tables[c.table], c.column)]
    if exact:
        parts.append(_fused_unique(tables, exact))
    # keys compared as text: both sides must have an exact text form of the same type
    rel = [c for c in checks if c.test == "relationships" and _exact_text(tables[c.table], c.column)
           and tables[c.table].schema[c.column].dataType == tables[c.to].schema[c.field].dataType]
    if rel:
        parts.append(_fused_relationships(tables, rel))
    for c in checks:
        df = tables[c.table]
        if c in exact or c in rel:
            continue
        if c.test == "unique":
            dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column)
                   .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
            parts.append(_row(c, dup.agg(F.count(F.lit(1)).alias("failures"))))
        elif c.test == "relationships":
            # child keys are counted first (partial aggregation), so a hot key
            # reaches the anti-join as one row with its count
            parent = tables[c.to].select(F.col(c.field).alias("_pk")).distinct()
            keys = (df.where(F.col(c.column).isNotNull()).groupBy(c.column)
                    .agg(F.count(F.lit(1)).alias("_n")))
            orphans = keys.join(parent, F.col(c.column) == F.col("_pk"), "left_anti")
            parts.append(_row(c, orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))))
        elif c.test not in ("not_null", "accepted_values"):
            raise ValueError(f"unknown test {c.test}")
    return reduce(DataFrame.unionByName, parts)


def _nn(t, *cols):
    return [Check(t, c, "not_null") for c in cols]


def _uq(t, *cols):
    return [Check(t, c, "unique") for c in cols]


# The warehouse's declared tests: 12 on sources, 11 on staging, 22 on marts.
WAREHOUSE_CHECKS: list[Check] = [
    *_uq("flagged_transactions", "transaction_id"),
    *_nn("flagged_transactions", "transaction_id", "amount"),
    *_uq("daily_fraud_summary", "summary_date"),
    *_nn("daily_fraud_summary", "summary_date"),
    *_uq("kaggle_loans", "loan_id"),
    *_nn("kaggle_loans", "loan_id", "loan_status"),
    Check("kaggle_loans", "loan_status", "accepted_values", (0, 1)),
    *_uq("cbsl_exchange_rates", "rate_date"),
    *_nn("cbsl_exchange_rates", "rate_date", "usd_lkr_rate"),
    *_uq("stg_flagged_transactions", "transaction_id"),
    *_nn("stg_flagged_transactions", "transaction_id", "amount", "event_date"),
    *_uq("stg_daily_fraud_summary", "summary_date"),
    *_nn("stg_daily_fraud_summary", "summary_date"),
    *_uq("stg_kaggle_loans", "loan_id"),
    *_nn("stg_kaggle_loans", "loan_id"),
    Check("stg_kaggle_loans", "loan_status", "accepted_values", (0, 1)),
    *_uq("stg_cbsl_exchange_rates", "rate_date"),
    *_nn("stg_cbsl_exchange_rates", "rate_date"),
    *_uq("dim_date", "date_key"),
    *_nn("dim_date", "date_key", "full_date", "is_weekend"),
    *_uq("dim_account", "account_key"),
    *_nn("dim_account", "account_key", "total_flags"),
    *_uq("dim_rule", "rule_key"),
    *_nn("dim_rule", "rule_key", "rule_name"),
    *_uq("fact_fraud_events", "transaction_id"),
    *_nn("fact_fraud_events", "transaction_id", "amount_usd", "amount_lkr", "date_key"),
    Check("fact_fraud_events", "date_key", "relationships", to="dim_date", field="date_key"),
    *_nn("fact_fraud_events", "account_key"),
    Check("fact_fraud_events", "account_key", "relationships", to="dim_account", field="account_key"),
    *_nn("fact_fraud_events", "rule_key"),
    Check("fact_fraud_events", "rule_key", "relationships", to="dim_rule", field="rule_key"),
    *_nn("mart_loan_risk", "loan_grade", "default_rate_pct"),
]

# Checks on parsed transactions (L4 and friends).
TRANSACTION_CHECKS: list[Check] = [
    *_uq("transactions", "transaction_id"),
    *_nn("transactions", "transaction_id", "nameOrig", "event_time", "amount"),
    Check("transactions", "type", "accepted_values", ("CASH-IN", "CASH-OUT", "DEBIT", "PAYMENT", "TRANSFER")),
    Check("transactions", "isFraud", "accepted_values", (0, 1)),
]
