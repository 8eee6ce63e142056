"""Table schemas, serving-table specs and `conform`.

A `TableSpec` states what a keyed serving table looks like: column types,
NOT NULL columns, defaults and the primary key.  `conform` turns any
DataFrame with the right column names into exactly that shape with one
projection (casts round doubles to the declared decimal scale).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Transaction event as it arrives on the wire (every field nullable).
TX_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
    T.StructField("anomaly_type", T.StringType()),
])

# Parsed event: wire fields less the two timestamp strings, plus typed times.
TX_COLUMNS = [f.name for f in TX_SCHEMA.fields
              if f.name not in ("timestamp", "ingestion_timestamp")] + ["event_time", "ingestion_time"]

# Seed transactions kept from the public simulation CSV.
SEED_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.ByteType()),
    T.StructField("isFlaggedFraud", T.ByteType()),
])

LOAN_CSV_COLUMNS = [
    "loan_id", "person_age", "person_income", "loan_amnt", "loan_int_rate",
    "loan_grade", "loan_intent", "loan_status", "cb_person_default_on_file",
]


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    nullable: bool = True
    default: object | None = None      # literal, or "now" for current_timestamp()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


def _c(name, dtype, nullable=True, default=None):
    return ColumnSpec(name, dtype, nullable, default)


D18_2 = T.DecimalType(18, 2)
D20_2 = T.DecimalType(20, 2)
D14_2 = T.DecimalType(14, 2)

# Names, precisions, keys and defaults of the serving tables.
# Counts are wider than there, so that no day or account can overflow them.
FLAGGED = TableSpec("flagged_transactions", (
    _c("transaction_id", T.StringType(), False),
    _c("event_time", T.TimestampType(), False),
    _c("tx_type", T.StringType()),
    _c("amount", D18_2),
    _c("origin_account", T.StringType()),
    _c("dest_account", T.StringType()),
    _c("rule_name", T.StringType()),
    _c("tx_count_5m", T.LongType()),
    _c("total_amount_5m", D18_2),
    _c("max_amount_5m", D18_2),
    _c("geo_impossible", T.ShortType(), True, 0),
    _c("detected_at", T.TimestampType(), True, "now"),
), key=("transaction_id",))

RAW = TableSpec("raw_transactions", (
    _c("transaction_id", T.StringType(), False),
    _c("event_time", T.TimestampType(), False),
    _c("ingestion_time", T.TimestampType()),
    _c("tx_type", T.StringType()),
    _c("amount", D18_2),
    _c("origin_account", T.StringType()),
    _c("old_balance_orig", D18_2),
    _c("new_balance_orig", D18_2),
    _c("dest_account", T.StringType()),
    _c("old_balance_dest", D18_2),
    _c("new_balance_dest", D18_2),
    _c("location", T.StringType()),
    _c("is_fraud", T.ShortType(), True, 0),
    _c("anomaly_type", T.StringType()),
), key=("transaction_id",))

DAILY_SUMMARY = TableSpec("daily_fraud_summary", (
    _c("summary_date", T.DateType(), False),
    _c("total_txns", T.LongType(), False, 0),
    _c("flagged_count", T.LongType(), False, 0),
    _c("total_amount", D20_2),
    _c("flagged_amount", D20_2),
    _c("top_rule", T.StringType()),
    _c("computed_at", T.TimestampType(), True, "now"),
), key=("summary_date",))

LOANS = TableSpec("kaggle_loans", (
    _c("loan_id", T.StringType(), False),
    _c("person_age", T.ShortType()),
    _c("person_income", D14_2),
    _c("loan_amnt", D14_2),
    _c("loan_int_rate", T.DecimalType(6, 3)),
    _c("loan_grade", T.StringType()),
    _c("loan_intent", T.StringType()),
    _c("loan_status", T.ShortType()),
    _c("cb_person_default_on_file", T.StringType()),
    _c("loaded_at", T.TimestampType(), True, "now"),
), key=("loan_id",))

RATES = TableSpec("cbsl_exchange_rates", (
    _c("rate_date", T.DateType(), False),
    _c("usd_lkr_rate", T.DecimalType(10, 4), False),
    _c("source_url", T.StringType()),
    _c("loaded_at", T.TimestampType(), True, "now"),
), key=("rate_date",))

SERVING_TABLES = {s.name: s for s in (FLAGGED, RAW, DAILY_SUMMARY, LOANS, RATES)}


def _default(c: ColumnSpec, now: Column | None) -> Column:
    if c.default == "now":
        return now if now is not None else F.current_timestamp()
    return F.lit(c.default).cast(c.dtype)


def conform(df: DataFrame, spec: TableSpec, now: Column | None = None,
            extra: list[str] | tuple = ()) -> DataFrame:
    """Project `df` onto `spec`: cast every column, fill defaults.

    A value that does not fit its column becomes null (see `misfits`).
    Missing columns become their default (or null).  Defaults apply to nulls
    too, like a database column default on an omitted value.  NOT NULL and
    key violations are *reported* by the quality suite, not silently dropped.
    `now` overrides `current_timestamp()` for audit columns (deterministic
    replays and tests).  `extra` columns are carried through unchanged.
    """
    present = set(df.columns)
    cols = []
    for c in spec.columns:
        if c.name in present:
            v = F.col(c.name).try_cast(c.dtype)
            if c.default is not None:
                v = F.coalesce(v, _default(c, now))
        elif c.default is not None:
            v = _default(c, now)
        else:
            v = F.lit(None).cast(c.dtype)
        cols.append(v.alias(c.name))
    return df.select(*cols, *extra)


def misfits(df: DataFrame, spec: TableSpec, names: dict[str, str] | None = None) -> Column:
    """Names of the columns whose value is there but does not fit `spec`, comma-joined; null if all fit.

    `names` maps columns of `df` to columns of the table where they differ.
    """
    names = names or {}
    types = {c.name: c.dtype for c in spec.columns}
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(types[names.get(c, c)]).isNull(), F.lit(c))
           for c in df.columns if names.get(c, c) in types]
    said = F.concat_ws(",", *bad)
    return F.when(said != "", said)
