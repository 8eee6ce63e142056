"""Lake and table writers.

A micro-batch is committed by a marker (`sinks.commits`), written after its data:

    <root>/data/batch_id=<id>/part=<token>/[dt=<day>/]files   one attempt's rows
    <root>/_commits/batch-<id>-<n>                            its marker: part, days, counts
    <root>/_commits/compact-<day>-<n>                         a day's parts folded into larger files

Readers go by the markers alone: what an attempt wrote that failed, or that has not got its marker yet, does
not exist for them, and a day's read lists that day's folders only. A batch that is delivered again gets
the next marker, and the newest counts. Parts of several sinks are committed together: every other
marker names the one of the lake, which is created last, and counts only beside it. Errors
propagate (the reference logs and swallows them, which commits a micro-batch whose data never landed).
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.dedup import dedup
from vigil.sinks import commits

#: Bytes of a file that compaction aims at.
COMPACT_BYTES = 128 << 20


def stage_batch(df: DataFrame, root: str, batch_id: int, by_day: bool, token: str | None = None) -> dict:
    """Write one attempt's rows; returns the content of its marker, which `commit_batch` publishes."""
    token = token or uuid.uuid4().hex[:16]
    path = f"{root.rstrip('/')}/data/batch_id={batch_id}/part={token}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy("dt") if by_day else writer).parquet(path)
    days = [n[3:] for n in commits.names(df.sparkSession, path) if n.startswith("dt=")] if by_day else None
    return {"batch_id": batch_id, "token": token, "days": days, "schema": df.schema.json()}


def commit_batch(spark: SparkSession, root: str, content: dict) -> None:
    """Make a staged part visible, as the newest of its batch."""
    folder = f"{root.rstrip('/')}/_commits"
    while True:
        known = [n for n in commits.names(spark, folder) if n.startswith(f"batch-{content['batch_id']:010d}-")]
        if known and _folded(spark, root) & {commits.read(spark, f"{folder}/{known[-1]}")["token"]}:
            raise ValueError(f"batch {content['batch_id']} has been compacted and cannot be written again")
        if commits.publish(spark, f"{folder}/batch-{content['batch_id']:010d}-{len(known):04d}", content):
            return


def _folded(spark: SparkSession, root: str) -> set[str]:
    """Tokens of parts that compactions have replaced."""
    return {t for c in compactions(spark, root) for t in c["tokens"]}


def compactions(spark: SparkSession, root: str) -> list[dict]:
    """Markers of all compactions."""
    folder = f"{root.rstrip('/')}/_commits"
    return [commits.read(spark, f"{folder}/{n}") for n in commits.names(spark, folder) if n.startswith("compact-")]


def committed_batches(spark: SparkSession, root: str) -> list[dict]:
    """The newest valid marker of every batch, in order."""
    folder, beside, newest = f"{root.rstrip('/')}/_commits", {}, {}
    for name in commits.names(spark, folder):
        if not name.startswith("batch-"):
            continue
        found = commits.read(spark, f"{folder}/{name}")
        if other := found.get("with"):
            if other not in beside:
                beside[other] = {m["token"] for m in committed_batches(spark, other)}
            if found["token"] not in beside[other]:
                continue
        newest[found["batch_id"]] = found
    return [newest[k] for k in sorted(newest)]


def last_commit(spark: SparkSession, root: str, before: int) -> dict | None:
    """The newest marker of the last batch below `before`."""
    folder = f"{root.rstrip('/')}/_commits"
    known = [n for n in commits.names(spark, folder) if "batch-" <= n < f"batch-{before:010d}"]
    return commits.read(spark, f"{folder}/{known[-1]}") if known else None


def write_lake_batch(scored: DataFrame, root: str, batch_id: int) -> str:
    """K1: all scored rows of one micro-batch, by day; visible once it is whole.

    A replayed batch replaces exactly what it wrote before, including days it no longer has.
    """
    content = stage_batch(scored, root, batch_id, True)
    commit_batch(scored.sparkSession, root, content)
    return f"{root.rstrip('/')}/data/batch_id={batch_id}/part={content['token']}"


def read_lake(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """S3 counterpart: committed rows with `batch_id` and `dt`; with `days`, of these days' folders only.

    Rows of an empty lake have the schema of its last batch, or the columns that summaries read.
    """
    base, wanted = f"{root.rstrip('/')}/data", set(days) if days is not None else None
    batches, folded = committed_batches(spark, root), compactions(spark, root)
    gone = {(c["day"], t) for c in folded for t in c["tokens"]}
    live = {n["path"] for n in folded} - {p for c in folded for p in c["paths"]}
    parts = [f"{base}/batch_id={b['batch_id']}/part={b['token']}/dt={d}" for b in batches for d in b["days"]
             if (wanted is None or d in wanted) and (d, b["token"]) not in gone]
    large = [f"{root.rstrip('/')}/{c['path']}/dt={c['day']}" for c in folded
             if c["path"] in live and (wanted is None or c["day"] in wanted)]
    frames = []
    if parts:
        frames.append(spark.read.option("basePath", base).parquet(*parts).drop("part"))
    if large:
        frames.append(spark.read.option("basePath", f"{root.rstrip('/')}/compacted").parquet(*large).drop("fold"))
    if frames:
        return frames[0].unionByName(frames[1], allowMissingColumns=True) if len(frames) > 1 else frames[0]
    schema = (T.StructType.fromJson(json.loads(batches[-1]["schema"])) if batches
              else T.StructType.fromDDL("dt string, amount double, is_fraud_detected boolean, rule_name string"))
    return spark.createDataFrame([], schema.add("batch_id", T.IntegerType()))


def compact_day(spark: SparkSession, root: str, day: str, file_bytes: int = COMPACT_BYTES) -> bool:
    """Fold a day's committed parts into files of about `file_bytes`; False if another compaction came first.

    Readers see either the parts or the fold. The rows, their batch ids included, stay as they are.
    """
    batches, earlier = committed_batches(spark, root), [c for c in compactions(spark, root) if c["day"] == day]
    gone = {t for c in earlier for t in c["tokens"]}
    tokens = [b["token"] for b in batches if day in b["days"] and b["token"] not in gone]
    live = {c["path"] for c in earlier} - {p for c in earlier for p in c["paths"]}
    if len(tokens) + len(live) < 2:
        return False
    folders = [f"{root.rstrip('/')}/data/batch_id={b['batch_id']}/part={b['token']}/dt={day}" for b in batches if b["token"] in tokens]
    size = 0
    for folder in folders + [f"{root.rstrip('/')}/{p}/dt={day}" for p in live]:
        fs, p = commits.file_system(spark, folder)
        size += fs.getContentSummary(p).getLength()
    path = f"compacted/fold={uuid.uuid4().hex[:16]}"
    rows = read_lake(spark, root, [day]).drop("dt").repartition(max(1, math.ceil(size / file_bytes)))
    rows.write.parquet(f"{root.rstrip('/')}/{path}/dt={day}")
    content = {"day": day, "tokens": tokens, "paths": sorted(live), "path": path}
    return commits.publish(spark, f"{root.rstrip('/')}/_commits/compact-{day}-{len(earlier):04d}", content)


def write_flagged_batch(serving: DataFrame, root: str, batch_id: int) -> str:
    """K2: flagged rows of one micro-batch, keyed by transaction_id downstream.

    Committed like a lake batch; `read_flagged` resolves key conflicts
    the way a primary key does (the first detection is kept).
    """
    content = stage_batch(serving, root, batch_id, False)
    commit_batch(serving.sparkSession, root, content)
    return f"{root.rstrip('/')}/data/batch_id={batch_id}/part={content['token']}"


def read_parts(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """Committed rows of a store without days, with `batch_id`; an empty store needs a `schema`."""
    base, batches = f"{root.rstrip('/')}/data", committed_batches(spark, root)
    if not batches:
        return spark.createDataFrame([], T.StructType.fromDDL(schema or "").add("batch_id", T.IntegerType()))
    return (spark.read.option("basePath", base)
            .parquet(*[f"{base}/batch_id={b['batch_id']}/part={b['token']}" for b in batches]).drop("part"))


def read_flagged(spark: SparkSession, root: str) -> DataFrame:
    """The serving table: one row per transaction_id, earliest batch wins."""
    return dedup(read_parts(spark, root), "transaction_id", ["batch_id", "detected_at"], keep="first").drop("batch_id")


def write_if_absent(df: DataFrame, path: str) -> None:
    """K6: write only when nothing exists at `path` (mode ignore)."""
    df.write.mode("ignore").parquet(path)


def overwrite_partitions(df: DataFrame, root: str, partition_col: str = "dt") -> None:
    """K7: replace only the partitions present in `df` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(root))


def write_snapshot(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """K8: a compressed Parquet snapshot."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """K9: expose a staging frame as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Materialise a mart (catalog table, or Parquet at `path`)."""
    w = df.write.mode("overwrite")
    if path:
        w.parquet(path)
    else:
        w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str]) -> None:
    """JDBC adaptor (driver jar must be on the classpath): append rows."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode("append")
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def add_dt(df: DataFrame, event_time: str = "event_time") -> DataFrame:
    return df.withColumn("dt", F.date_format(event_time, "yyyy-MM-dd"))
