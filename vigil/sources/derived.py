"""Fraud-domain tables derived from the generic test tables.

The driver ships TPC-H-ish parquet (`events`, `orders`, `customer`, ...).
These functions turn them into the shapes the fraud library consumes, with
plain projections, so every registered query reads the given tables and its
work grows with them:

* `transactions`  parsed transaction events, from `events`
* `rates`         one USD/LKR rate per event date, from `events`
* `loans`         loan applications, from `orders` joined to `customer`
* `raw_wire`      the wire form of `transactions` (K11), a few rows broken

The DuckDB oracle builds the same views with the SQL in `vigil.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (shared with the DuckDB oracle views).
# ---------------------------------------------------------------------------
ZONES = 10                   # locations are Z0 to Z9
EVENT_TYPE_TO_TX_TYPE = {
    "view": "PAYMENT",
    "click": "CASH-OUT",
    "error": "DEBIT",
    "purchase": "TRANSFER",
    "signup": "CASH-IN",
}
ANOMALY_BY_K = {13: "geo_impossible", 42: "large_amount", 77: "rapid_fire", 88: "odd_hour"}
AMOUNT_SCALE = 5000          # event value 100.00 -> amount 500 000.00
DEST_MODULUS = 150           # destination account = (user * 7 + 1) mod 150
LEDGER_BREAK_K = 99          # rows whose origin balance is off by one (for L1)
SELF_TRANSFER_K = 0          # rows paid to the origin account itself (for L3)
BROKEN_JSON_K = 57           # rows whose wire JSON is truncated (for S1)
RATE_BASE, RATE_STEP = 290, 0.25
# ---------------------------------------------------------------------------


# The driver's tables are fixed inputs, so each view is built (and analysed)
# once per session and folder, as a catalog would hold a registered view.  A
# DataFrame is an immutable plan: every query that reuses one still scans the
# files, and Catalyst still prunes columns and pushes filters per query.
_VIEWS: dict[tuple, DataFrame] = {}


def _view(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark, sf_dir.rstrip("/"), name)
    df = _VIEWS.get(key)
    if df is None:
        df = _VIEWS[key] = build()
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _view(spark, sf_dir, "table:" + name, lambda: spark.read.parquet(path))


def _case(col: Column, mapping: dict, otherwise=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed transaction events (TX_COLUMNS order), one per `events` row."""
    return _view(spark, sf_dir, "transactions", lambda: _with_k(spark, sf_dir).drop("_k"))


def _with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "with_k", lambda: _build_with_k(spark, sf_dir))


def _build_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    amount = (F.col("value").cast("decimal(18,2)") * F.lit(AMOUNT_SCALE)).cast("double")
    tx_type = _case(F.col("event_type"), EVENT_TYPE_TO_TX_TYPE)
    old_orig = ((k + 1) * 10000).cast("double")
    old_dest = (k * 500).cast("double")
    base = e.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("event_id").alias("step"),
        tx_type.alias("type"),
        amount.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        old_orig.alias("oldbalanceOrg"),
        F.col("user_id").alias("_user"),
        k.alias("_k"),
        old_dest.alias("oldbalanceDest"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )
    k = F.col("_k")
    amt = F.col("amount")
    new_orig = (F.when(F.col("type") == "CASH-IN", F.col("oldbalanceOrg") + amt)
                .otherwise(F.col("oldbalanceOrg") - amt)
                + F.when(k == LEDGER_BREAK_K, F.lit(1.0)).otherwise(F.lit(0.0)))
    new_dest = (F.when(F.col("type") == "TRANSFER", F.col("oldbalanceDest") + amt)
                .otherwise(F.col("oldbalanceDest")))
    dest = F.when(k == SELF_TRANSFER_K, F.col("nameOrig")).otherwise(
        F.concat(F.lit("C"), ((F.col("_user") * 7 + 1) % DEST_MODULUS).cast("string")))
    anomaly = _case(k, ANOMALY_BY_K)
    return base.select(
        "transaction_id", "step", "type", "amount", "nameOrig", "oldbalanceOrg",
        new_orig.alias("newbalanceOrig"),
        dest.alias("nameDest"),
        "oldbalanceDest",
        new_dest.alias("newbalanceDest"),
        F.concat(F.lit("Z"), (k % ZONES).cast("string")).alias("location"),
        F.when(anomaly.isNull(), 0).otherwise(1).cast("int").alias("isFraud"),
        F.lit(0).cast("int").alias("isFlaggedFraud"),
        anomaly.alias("anomaly_type"),
        "event_time",
        (F.col("event_time") + F.make_dt_interval(secs=k.cast("decimal(8,6)"))).alias("ingestion_time"),
        k.alias("_k"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per distinct event date: 290 + 0.25 x day of month."""
    return _view(spark, sf_dir, "rates", lambda: _build_rates(spark, sf_dir))


def _build_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = (table(spark, sf_dir, "events")
         .select(F.to_date(F.col("ts").cast("timestamp")).alias("rate_date"))
         .distinct())
    return d.select(
        "rate_date",
        (F.lit(RATE_BASE) + F.lit(RATE_STEP) * F.dayofmonth("rate_date")).cast("decimal(10,4)")
        .alias("usd_lkr_rate"),
        F.lit("derived:events").alias("source_url"),
        F.col("rate_date").cast("timestamp").alias("loaded_at"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan rows (LOANS column names) from orders joined to their customer."""
    return _view(spark, sf_dir, "loans", lambda: _build_loans(spark, sf_dir))


def _build_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.select(
        F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias("loan_id"),
        (F.lit(18) + F.col("o_custkey") % 50).cast("short").alias("person_age"),
        F.greatest(F.col("c_acctbal").cast("decimal(14,2)") * 10, F.lit(0))
        .cast("decimal(14,2)").alias("person_income"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("loan_amnt"),
        ((F.col("o_orderkey") % 2000).cast("decimal(6,0)") / 100).cast("decimal(6,3)").alias("loan_int_rate"),
        F.lower(F.substring("c_mktsegment", 1, 1)).alias("loan_grade"),
        F.col("o_orderpriority").alias("loan_intent"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("short").alias("loan_status"),
        F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N").alias("cb_person_default_on_file"),
    )


def wire_events(tx: DataFrame) -> DataFrame:
    """Transactions back in wire form: string timestamps, TX_SCHEMA field names."""
    keep = [c for c in tx.columns if c.startswith("_")]
    return tx.select(
        "transaction_id",
        F.date_format("ingestion_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingestion_timestamp"),
        "step",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
        "oldbalanceDest", "newbalanceDest", "location", "isFraud", "isFlaggedFraud", "anomaly_type",
        *keep,
    )


def raw_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped (key, value) bytes of `transactions`.

    Rows whose props k equals BROKEN_JSON_K carry truncated JSON, so the
    parser's corrupt-record path is exercised by real rows of the table.
    """
    from vigil.sources.transactions import encode_events
    tx = _with_k(spark, sf_dir)
    enc = encode_events(wire_events(tx), extra=[F.col("_k")])
    broken = F.substring(F.col("value").cast("string"), 1, 40).cast("binary")
    return enc.select(
        "key",
        F.when(F.col("_k") == BROKEN_JSON_K, broken).otherwise(F.col("value")).alias("value"))
