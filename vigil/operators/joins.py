"""Skew-safe equi-join against a per-key aggregate (dimension or statistics).

When the right side is an aggregate (one row per key) Spark's AQE cannot
split a skewed left partition (its skew-join rule needs bare shuffles on both
sides).  `salted_left_join` does it explicitly: keys whose left-side row
count (known from the aggregate itself) exceeds `hot_rows` are spread over
ceil(count / hot_rows) salts; their right row is replicated once per salt.
The broadcast list holds the HOT_KEYS hottest keys at most: any further key has
less than 1 / HOT_KEYS of the rows and needs no salt.  Rows with a null key never
match and are spread over NULL_SALTS tasks.  Salts are hashes of the row, so a
retried task deals its rows out as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
NULL_SALTS = 1024


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (equal rows share it)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def salt_of(df: DataFrame, key: Column, n_salt: Column) -> Column:
    """0 for ordinary keys, a row hash below `n_salt` for hot ones, below NULL_SALTS for null keys."""
    # the hash is named once: it holds every column's expression
    return F.pmod(row_hash(df), F.when(key.isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce(n_salt, F.lit(1)))).cast("int")


def salted_left_join(left: DataFrame, right: DataFrame, key: str, count: Column,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """left LEFT JOIN right USING (key); `count` = the key's row count on the left,
    as an expression over `right`.  Null keys never match (plain equality)."""
    n_salt = F.ceil(count / F.lit(hot_rows)).cast("int")
    r = right.withColumn("_n_salt", F.greatest(n_salt, F.lit(1)))
    hot = (r.where(F.col("_n_salt") > 1).orderBy(F.desc("_n_salt")).limit(HOT_KEYS)
           .select(F.col(key).alias("_h_key"), "_n_salt"))
    rows = (left.join(F.broadcast(hot), F.col(key) == F.col("_h_key"), "left")
                .withColumn("_salt", salt_of(left, F.col(key), F.col("_n_salt")))
                .drop("_h_key", "_n_salt"))
    rx = (r.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.col("_n_salt") - 1)))
           .drop("_n_salt").withColumnRenamed(key, "_r_key"))
    j = rows.join(rx, (F.col(key) == F.col("_r_key")) & (F.col("_salt") == F.col("_r_salt")), "left")
    return j.drop("_r_key", "_salt", "_r_salt")
