"""Building the warehouse: staging -> dimensions, fact, mart -> tests (§3.3).

The model graph is just function composition; Spark's lazy plans are the
dependency graph.  Marts are materialised (K10) once under `out_root`, then
the declared tests run over the stored tables, so each mart is computed a
single time however many tests or dashboards read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.operators.quality import WAREHOUSE_CHECKS, run_checks
from vigil.plans import marts, staging
from vigil.schemas import DAILY_SUMMARY, FLAGGED, LOANS, RATES
from vigil.sinks.lake import read_flagged
from vigil.sinks.upsert import merge_frames, read_table, upsert


def compact_flagged(spark: SparkSession, batches_root: str, table_root: str) -> str:
    """K2 compaction: fold the per-batch flagged store into the keyed table.

    Insert-if-absent (a primary-key conflict keeps the stored row, like the
    serving database rejecting a duplicate key), so compacting the same
    batches twice changes nothing.
    """
    fresh = read_flagged(spark, batches_root)
    return upsert(spark, table_root, fresh, FLAGGED, update_cols=[])


def build_warehouse(spark: SparkSession, flagged_root: str, summary_root: str, loans_root: str,
                    rates_root: str, out_root: str) -> dict[str, DataFrame]:
    """Read the keyed serving tables, write every staging view and mart under
    `out_root/<name>`, run the 45 declared tests and store their results in
    `out_root/test_results`.  Returns the stored tables."""
    src = {
        "flagged_transactions": read_table(spark, flagged_root, FLAGGED),
        "daily_fraud_summary": read_table(spark, summary_root, DAILY_SUMMARY),
        "kaggle_loans": read_table(spark, loans_root, LOANS),
        "cbsl_exchange_rates": read_table(spark, rates_root, RATES),
    }
    missing = [k for k, v in src.items() if v is None]
    if missing:
        raise FileNotFoundError(f"no committed version for: {', '.join(missing)}")
    stg = {
        "stg_flagged_transactions": staging.stg_flagged(src["flagged_transactions"]),
        "stg_daily_fraud_summary": staging.stg_daily_summary(src["daily_fraud_summary"]),
        "stg_kaggle_loans": staging.stg_loans(src["kaggle_loans"]),
        "stg_cbsl_exchange_rates": staging.stg_rates(src["cbsl_exchange_rates"]),
    }
    f, r = stg["stg_flagged_transactions"], stg["stg_cbsl_exchange_rates"]
    built = {
        "dim_date": marts.dim_date(f),
        "dim_account": marts.dim_account(f),
        "dim_rule": marts.dim_rule(f),
        "fact_fraud_events": marts.fact_fraud_events(f, r),
        "mart_loan_risk": marts.mart_loan_risk(stg["stg_kaggle_loans"], r),
    }
    stored: dict[str, DataFrame] = {}
    for name, df in built.items():
        path = f"{out_root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        stored[name] = spark.read.parquet(path)
    tables = {**src, **stg, **stored}
    results = run_checks(tables, WAREHOUSE_CHECKS)
    results.write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/test_results")
    stored["test_results"] = spark.read.parquet(f"{out_root.rstrip('/')}/test_results")
    return stored


__all__ = ["build_warehouse", "compact_flagged", "merge_frames"]
