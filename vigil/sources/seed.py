"""The seed transaction sample.

The public simulation CSV has eleven columns; only eight are kept.  With a
full positional schema Spark's CSV reader parses just the selected columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import SEED_SCHEMA

# ---------------------------------------------------------------------------
# Column layout of the public seed CSV and the fallback profile
# used when no seed file exists.
# ---------------------------------------------------------------------------
SEED_CSV_COLUMNS = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
                    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]
FALLBACK_TX_WEIGHTS = {"CASH-IN": 0.22, "CASH-OUT": 0.35, "PAYMENT": 0.34, "TRANSFER": 0.08, "DEBIT": 0.01}
FALLBACK_AMOUNT = {"amount_mean": 50_000.0, "amount_std": 80_000.0, "amount_min": 1.0, "amount_max": 500_000.0}
FALLBACK_BALANCE = {"balance_p5": 100.0, "balance_p95": 50_000.0, "balance_mean": 10_000.0,
                    "balance_std": 20_000.0}
# ---------------------------------------------------------------------------

KEEP = [f.name for f in SEED_SCHEMA.fields]


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """The eight kept columns with their types (column pruning is Spark's)."""
    types = {f.name: f.dataType for f in SEED_SCHEMA.fields}
    full = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in SEED_CSV_COLUMNS])
    return spark.read.option("header", True).schema(full).csv(path).select(*KEEP)


def read_seed_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet snapshot, or None when it does not exist."""
    from vigil.sinks.commits import file_system
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    return spark.read.parquet(path).select(*KEEP)


def fallback_profile(spark: SparkSession) -> DataFrame:
    """S8 fallback: the constant per-type profile, shaped like `amount_profile`."""
    rows = [(t, w, *FALLBACK_AMOUNT.values()) for t, w in FALLBACK_TX_WEIGHTS.items()]
    cols = ["type", "weight", *FALLBACK_AMOUNT.keys()]
    return spark.createDataFrame(rows, cols)


def fallback_balance(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(FALLBACK_BALANCE.values())], list(FALLBACK_BALANCE))


def profile_or_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Amount profile of the seed if present, else the fallback constants."""
    from vigil.operators.profile import amount_profile
    seed = read_seed_parquet(spark, path)
    if seed is None:
        return fallback_profile(spark)
    return amount_profile(seed).select("type", "weight", *FALLBACK_AMOUNT.keys())
