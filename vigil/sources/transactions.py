"""Transaction events on the wire: parse (S1), Kafka source (S2), encode.

`parse_transactions` works unchanged on a static DataFrame and on a
streaming one: it is a projection over a binary/string `value` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import TX_COLUMNS, TX_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def parse_transactions(raw: DataFrame, value_col: str = "value",
                       keep: list[str] | None = None) -> DataFrame:
    """JSON `value` -> flat typed columns plus `_corrupt_record`.

    Parsing is PERMISSIVE like the reference: a malformed message becomes an
    all-null row that stays in the batch, but here it also keeps its text in
    `_corrupt_record` so `split_corrupt` can quarantine it.  Timestamps use
    `try_to_timestamp`, so bad text yields null instead of failing the batch
    under ANSI mode.  `keep` carries extra source columns (e.g. Kafka offsets).
    """
    schema = T.StructType(TX_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    text = F.col(value_col).cast("string")
    parsed = raw.select(
        *(keep or []),
        F.from_json(text, schema, {"mode": "PERMISSIVE",
                                   "columnNameOfCorruptRecord": CORRUPT_COLUMN}).alias("d"))
    d = lambda c: F.col(f"d.{c}")
    cols = [d(c).alias(c) for c in TX_COLUMNS if c not in ("event_time", "ingestion_time")]
    return parsed.select(
        *(keep or []),
        *cols,
        F.try_to_timestamp(d("timestamp")).alias("event_time"),
        F.try_to_timestamp(d("ingestion_timestamp")).alias("ingestion_time"),
        d(CORRUPT_COLUMN).alias(CORRUPT_COLUMN),
    )


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, corrupt): corrupt rows are those whose JSON failed to parse."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return parsed.where(~bad).drop(CORRUPT_COLUMN), parsed.where(bad)


def encode_events(wire: DataFrame, key: str = "transaction_id",
                  extra: list[Column] | None = None) -> DataFrame:
    """key = id bytes, value = JSON bytes of every wire column."""
    payload = [c for c in wire.columns if not c.startswith("_")]
    return wire.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        *(extra or []))


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 **options: str) -> DataFrame:
    """Streaming reader for one topic (needs the Kafka connector jar)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming stand-in for Kafka: JSON lines in a folder -> `value` column."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """K11 sink: stream encoded events to a topic."""
    return (df.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start())
