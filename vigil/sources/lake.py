"""Reading the lake (S3) and the serving tables (S7), shard unions (T4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sinks.lake import read_lake


def read_lake_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """S3 + F5: every committed shard of one `dt` partition.

    The commit markers name the day's folders, so only these are listed and read.
    """
    return read_lake(spark, root, [day]).where(F.col("dt") == F.lit(day))


def union_shards(frames: list[DataFrame]) -> DataFrame:
    """T4: union by column name; shards written before a column existed get nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_source(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table (or temp view) by name."""
    return spark.table(name)


def jdbc_source(spark: SparkSession, url: str, table: str, props: dict[str, str]) -> DataFrame:
    """S7 over JDBC (the driver jar must be on the classpath)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()
