"""Exchange-rate payloads.

Re-aimed from an HTTP call to landed payload files: each file (or string)
holds one JSON document `{"rates": {"LKR": <number>}, ...}`.  The rate is
read by JSON path; a payload without a usable rate takes the fallback rate
with source "fallback" instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
FALLBACK_LKR_RATE = 300.0
FALLBACK_SOURCE = "fallback"
RATE_PATH = "$.rates.LKR"
# ---------------------------------------------------------------------------


def parse_rate_payload(payload: Column, source_url: Column) -> list[Column]:
    rate = F.get_json_object(payload, RATE_PATH).try_cast("double")
    return [F.coalesce(rate, F.lit(FALLBACK_LKR_RATE)).cast("decimal(10,4)").alias("usd_lkr_rate"),
            F.when(rate.isNull(), F.lit(FALLBACK_SOURCE)).otherwise(source_url).alias("source_url")]


def rates_from_payloads(df: DataFrame, payload: str = "payload", rate_date: str = "rate_date",
                        source_url: str = "source_url") -> DataFrame:
    """(rate_date, payload text, source) rows -> rate rows."""
    return df.select(F.col(rate_date).cast("date").alias("rate_date"),
                     *parse_rate_payload(F.col(payload), F.col(source_url)))


def read_rate_files(spark: SparkSession, root: str, source_url: str) -> DataFrame:
    """Landed files `root/dt=YYYY-MM-DD/*.json`, one document per file."""
    raw = spark.read.option("wholetext", True).text(root)
    return rates_from_payloads(raw.withColumnRenamed("value", "payload")
                               .withColumn("rate_date", F.col("dt"))
                               .withColumn("source_url", F.lit(source_url)))
