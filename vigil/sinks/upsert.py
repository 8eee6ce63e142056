"""Keyed upsert without a table format (K3, K4, K5).

`merge_frames` is the set-based form of INSERT ... ON CONFLICT DO UPDATE:

* the source is first reduced to one row per key, the last by an explicit
  ordering column (N18) -- an aggregate, so a key repeated a billion times
  costs one row per input task;
* a full outer join on the key with explicit match markers decides, column by
  column, whether the source value (update columns, or a new key) or the
  target value (kept columns, N17) survives -- a null in the source can
  overwrite, and a kept column is never touched;
* audit columns (`now_cols`) take `now` on every updated row and on inserted
  rows that carry no value; `update_cols=[]` gives insert-if-absent.

A stored table is cut into buckets by a hash of the key:

    <root>/data/<token>/part=<bucket>/files    rows that one upsert has written
    <root>/_versions/<n>                       marker of version n: the folder of every bucket

`upsert` reads and rewrites the buckets that the source touches; the next version's marker takes the other
folders over as they are. Only one writer can create a version's marker (`sinks.commits`): another
one that prepared the same version merges again onto the winner's, or, where the winner touched other
buckets only, just publishes its own folders beside the winner's. Readers take the newest version, so
a failed job never leaves a half-written table. With a table format on the classpath, `MERGE INTO` is the
production equivalent.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schemas import TableSpec, conform
from vigil.sinks import commits

#: Buckets of a new table, and how often an upsert merges again when others are faster.
BUCKETS, ATTEMPTS = 16, 20
BUCKET_COLUMN = "part"


def latest_per_key(source: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last row per key by `order` (ties: the larger row)."""
    rest = [c for c in source.columns if c not in key]
    payload = F.struct(*[F.col(c) for c in rest])
    return (source.groupBy(*key)
            .agg(F.max_by(payload, F.struct(F.col(order), payload)).alias("_r"))
            .select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def merge_frames(target: DataFrame | None, source: DataFrame, key: Sequence[str],
                 update_cols: Sequence[str] | None = None, order: str | None = None,
                 now_cols: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """Upsert `source` into `target` by `key`; returns the new table contents.

    `update_cols` (default: every non-key column) change on conflict; the
    other columns keep the target's value.  Columns come out in the target's
    order (the source's when there is no target).
    """
    key = list(key)
    now = now if now is not None else F.current_timestamp()
    # without an order the larger row of a repeated key wins: a rule, not chance
    src = latest_per_key(source.withColumn("_none", F.lit(0)), key, "_none").drop("_none") if not order else \
        latest_per_key(source, key, order)
    if order and order not in (target.columns if target is not None else []):
        src = src.drop(order)
    cols = target.columns if target is not None else src.columns
    data_cols = [c for c in cols if c not in key]
    upd = set(update_cols) if update_cols is not None else set(data_cols)
    if target is None:
        return src.select(*key, *[(now.alias(c) if c in now_cols else F.col(c)) for c in data_cols])
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in src.columns], F.lit(True).alias("_s_hit"))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    cond = None
    for k in key:
        c = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    s_hit = F.coalesce(F.col("_s_hit"), F.lit(False))
    t_hit = F.coalesce(F.col("_t_hit"), F.lit(False))
    out = [F.when(s_hit, F.col(f"_s_{k}")).otherwise(F.col(f"_t_{k}")).alias(k) for k in key]
    updating = bool(upd)
    for c in data_cols:
        if c in now_cols:
            # audit column: an inserted row keeps a given value (else now); an
            # updated row gets now; with no update columns a conflict changes
            # nothing (insert-if-absent, like ON CONFLICT DO NOTHING)
            ins = F.coalesce(F.col(f"_s_{c}"), now) if c in src.columns else now
            v = F.when(s_hit & ~t_hit, ins)
            if updating:
                v = v.when(s_hit & t_hit, now)
            v = v.otherwise(F.col(f"_t_{c}"))
        elif c in upd and c in src.columns:
            v = F.when(s_hit, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}"))
        elif c in src.columns:
            v = F.when(t_hit, F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}"))
        else:
            v = F.col(f"_t_{c}")
        out.append(v.alias(c))
    return j.select(*out)


# ---------------------------------------------------------------- versioned storage

def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is at `path`, in any store that Spark reads."""
    fs, p = commits.file_system(spark, path)
    return fs.exists(p)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers of the table at `root`."""
    return [int(n) for n in commits.names(spark, f"{root.rstrip('/')}/_versions") if n.isdigit()]


def version(spark: SparkSession, root: str) -> dict | None:
    """The newest version: its number, `buckets`, and the folder of every bucket that has rows."""
    known = committed_versions(spark, root)
    return {**commits.read(spark, f"{root.rstrip('/')}/_versions/{known[-1]:08d}"), "number": known[-1]} if known else None


def _rows(spark: SparkSession, root: str, folders: list[str], spec: TableSpec | None) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], spec.schema)
    reader = spark.read.schema(spec.schema) if spec else spark.read
    return reader.parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])


def read_table(spark: SparkSession, root: str, spec: TableSpec | None = None) -> DataFrame | None:
    now = version(spark, root)
    if now is None or not (spec or now["parts"]):
        return None
    return _rows(spark, root, [now["parts"][b] for b in sorted(now["parts"])], spec)


def bucket_of(spec: TableSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in spec.key]), F.lit(buckets)).cast("int")


def upsert(spark: SparkSession, root: str, source: DataFrame, spec: TableSpec,
           update_cols: Sequence[str] | None = None, order: str | None = None,
           now: Column | None = None, buckets: int = BUCKETS, prepared: Callable[[], None] | None = None) -> str:
    """Merge `source` into the table at `root`; returns the new version's marker.

    `buckets` counts for a new table; `prepared` is called before each publication (tests).
    """
    root = root.rstrip("/")
    extra = [order] if order and order not in spec.names else []
    src = conform(source, spec, now=F.lit(None).cast("timestamp"), extra=extra)
    now_cols = [c.name for c in spec.columns if c.default == "now"]
    for _ in range(ATTEMPTS):
        base = version(spark, root)
        n = base["buckets"] if base else buckets
        # at most `n` rows
        touched = [str(r[0]) for r in src.select(bucket_of(spec, n)).distinct().collect()]
        target = None
        if base:
            target = _rows(spark, root, [base["parts"][b] for b in touched if b in base["parts"]], spec)
        merged = conform(merge_frames(target, src, spec.key, update_cols, order, now_cols, now), spec, now=now)
        data = f"data/{uuid.uuid4().hex[:16]}"
        (merged.withColumn(BUCKET_COLUMN, bucket_of(spec, n)).repartition(BUCKET_COLUMN)
         .write.partitionBy(BUCKET_COLUMN).parquet(f"{root}/{data}"))
        written = {f.split("=")[1]: f"{data}/{f}" for f in commits.names(spark, f"{root}/{data}") if f.startswith(f"{BUCKET_COLUMN}=")}
        if prepared:
            prepared()
        parts = base["parts"] if base else {}
        before = {b: parts.get(b) for b in touched}
        while base is None or base["buckets"] == n:
            content = {"buckets": n, "parts": {**{b: f for b, f in parts.items() if b not in before}, **written}}
            marker = f"{root}/_versions/{(base['number'] if base else 0) + 1:08d}"
            if commits.publish(spark, marker, content):
                return marker
            base = version(spark, root)  # another writer was faster
            parts = base["parts"]
            if {b: parts.get(b) for b in touched} != before:
                break  # it changed what was read here: merge again
    raise RuntimeError(f"no version of {root} could be published in {ATTEMPTS} attempts")
