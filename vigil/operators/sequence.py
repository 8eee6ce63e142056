"""Per-key sequence operators that survive a hot key (X1-X3, L2 building blocks).

A window `partitionBy(account).orderBy(time)` sends every row of an account
to one task; with one account holding a third of the data that task never
finishes.  Every operator here partitions rows by (key, time bucket) instead
and repairs the bucket edges exactly:

* `previous_value`  lag within the bucket; the first row of a bucket takes the
                     last row of the previous non-empty bucket, found in a
                     per-(key, bucket) summary (one row per bucket).
* `running_totals`  running sum / count within the bucket plus an offset: the
                     prefix sum of earlier buckets' totals, again from the
                     per-bucket summary.
* `trailing_window` a range frame of W seconds, by blocks of W seconds: the
                     frame of a row is the beginning of its own block and the
                     end of the block before (copied to the block), so a running aggregate forwards
                     and one backwards give count, sum and max in linear time.

Rows without a key or time have no sequence; they are spread over all tasks by
a hash of the row instead of meeting in one window.

The row side is shuffled once, by (key, bucket, part); the summaries are one row
per key-bucket and are the only data that is windowed by key alone.  A bucket with more than `hot_rows` rows is cut into
parts of equal depth (`parted`), so an account with a third of all rows in one
hour is spread as well.  Results depend neither on the bucket width nor on the parts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.joins import HOT_KEYS, HOT_ROWS, row_hash

MICROS = 1_000_000
#: Parts of a hot bucket.  The broadcast cuts take at most HOT_KEYS * PARTS * 8 bytes (20 MB).
PARTS = 256


def time_bucket(ts: str | Column, bucket_seconds: int) -> Column:
    """Integer bucket of a timestamp: floor(epoch micros / width)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c) / F.lit(bucket_seconds * MICROS)).cast("long")


def _spread(df: DataFrame, valid: Column) -> Column:
    """0 for rows with a sequence, a hash of the row for the others."""
    return F.when(valid, F.lit(0).cast("long")).otherwise(row_hash(df))


def _number(df: DataFrame, value: str) -> Column:
    """The value, NaN as null."""
    c = F.col(value)
    return F.when(~F.isnan(c), c) if df.schema[value].dataType.typeName() in ("double", "float") else c


def parted(df: DataFrame, key: str, order: str, bucket: Column, valid: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`df` with its bucket `_b` (null for rows without a sequence) and the part `_p` of a hot bucket (else 0).

    Rows are counted per (key, bucket).  Buckets with more than `hot_rows` rows (the HOT_KEYS largest; any other has
    less than 1 / HOT_KEYS of the rows) get cuts of equal depth along the order from a sketch of
    fixed size, sent to all tasks.  Rows at one instant stay together; parts follow the order.
    """
    if {"_b", "_p"} <= set(df.columns):  # from an operator before this one, along the same order
        return df
    t = df.withColumn("_b", F.when(valid, bucket))
    kind = df.schema[order].dataType.typeName()
    if kind not in ("timestamp", "date", "long", "integer", "short", "byte"):
        return t.withColumn("_p", F.lit(0))
    place = (F.unix_micros(F.col(order).cast("timestamp")) if kind in ("timestamp", "date") else F.col(order).cast("long"))
    seen = t.where(valid).select(F.col(key).alias("_hk"), F.col("_b").alias("_hb"), place.alias("_at"))
    hot = (seen.groupBy("_hk", "_hb").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
           .orderBy(F.desc("_n")).limit(HOT_KEYS).select("_hk", "_hb"))
    cuts = F.broadcast(seen.join(F.broadcast(hot), ["_hk", "_hb"], "left_semi").groupBy("_hk", "_hb").agg(
        F.percentile_approx("_at", [k / PARTS for k in range(1, PARTS)], 20 * PARTS).alias("_cuts")))
    met = t.join(cuts, (F.col(key) == F.col("_hk")) & (F.col("_b") == F.col("_hb")), "left")
    part = F.size(F.filter(F.array_distinct("_cuts"), lambda c: c < place))
    return met.withColumn("_p", F.when(F.col("_cuts").isNull(), 0).otherwise(part)).drop("_hk", "_hb", "_cuts")


def previous_value(df: DataFrame, key: str, order: str, values: Sequence[str],
                   bucket: Column, tiebreak: Sequence[str] = (), prefix: str = "prev_",
                   hot_rows: int = HOT_ROWS, keep_parts: bool = False) -> DataFrame:
    """For each row, `values` of the key's previous row by (order, *tiebreak).

    Rows with a null key or null order have no sequence: their prev_* are null
    and they are nobody's previous row.
    """
    ordering = [F.col(order), *[F.col(t) for t in tiebreak]]
    valid = F.col(key).isNotNull() & F.col(order).isNotNull()
    t = parted(df, key, order, bucket, valid, hot_rows).withColumn("_s", _spread(df, valid))
    w = Window.partitionBy(key, "_b", "_p", "_s").orderBy(*ordering)
    for v in values:
        t = t.withColumn(f"_lag_{v}", F.lag(v).over(w))
    t = t.withColumn("_first", F.lag(F.lit(1)).over(w).isNull())

    summary = (t.where(F.col("_b").isNotNull())
               .groupBy(key, "_b", "_p")
               .agg(F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*ordering)).alias("_last")))
    carry = summary.select(key, "_b", "_p", F.lit(0).cast("long").alias("_s"),
                           F.lag("_last").over(Window.partitionBy(key).orderBy("_b", "_p")).alias("_carry"))
    j = t.join(carry, [key, "_b", "_p", "_s"], "left")
    out = j
    for v in values:
        pv = F.when(F.col("_first"), F.col(f"_carry.{v}")).otherwise(F.col(f"_lag_{v}"))
        out = out.withColumn(f"{prefix}{v}", F.when(F.col("_b").isNotNull(), pv))
    return out.drop(*([] if keep_parts else ["_b", "_p"]), "_s", "_first", "_carry", *[f"_lag_{v}" for v in values])


def running_totals(df: DataFrame, key: str, order: str, value: str, bucket: Column,
                   tiebreak: Sequence[str] = (), inclusive: bool = False,
                   sum_name: str = "prior_sum", count_name: str = "prior_count", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sum and count of the key's earlier rows' `value` (or up to and
    including the row when `inclusive`).  Exact two-level prefix sum: within
    (key, bucket) by window, across buckets by a prefix over bucket totals.
    NaN values count as rows but add nothing."""
    ordering = [F.col(order), *[F.col(t) for t in tiebreak]]
    valid = F.col(key).isNotNull() & F.col(order).isNotNull()
    t = parted(df, key, order, bucket, valid, hot_rows).withColumn("_s", _spread(df, valid))
    end = 0 if inclusive else -1
    w = Window.partitionBy(key, "_b", "_p", "_s").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, end)
    number = _number(df, value)
    t = (t.withColumn("_in_sum", F.sum(number).over(w))
          .withColumn("_in_cnt", F.count(value).over(w)))
    totals = (t.where(F.col("_b").isNotNull()).groupBy(key, "_b", "_p")
              .agg(F.sum(number).alias("_bs"), F.count(value).alias("_bc")))
    wb = Window.partitionBy(key).orderBy("_b", "_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_b", "_p", F.lit(0).cast("long").alias("_s"), F.sum("_bs").over(wb).alias("_off_sum"),
                            F.sum("_bc").over(wb).alias("_off_cnt"))
    j = t.join(offsets, [key, "_b", "_p", "_s"], "left")
    cnt = F.coalesce("_in_cnt", F.lit(0)) + F.coalesce("_off_cnt", F.lit(0))
    tot = F.coalesce("_in_sum", F.lit(0)) + F.coalesce("_off_sum", F.lit(0))
    return (j.withColumn(count_name, F.when(F.col("_b").isNotNull(), cnt))
             .withColumn(sum_name, F.when(F.col("_b").isNotNull(), tot))
             .drop("_b", "_p", "_s", "_in_sum", "_in_cnt", "_off_sum", "_off_cnt"))


def trailing_window(df: DataFrame, key: str, ts: str, value: str, seconds: int,
                    bucket_seconds: int = 3600, prefix: str = "trail_") -> DataFrame:
    """Count, sum and max of `value` over the key's rows with time in
    [t - seconds, t] (rows at the same instant count).

    Linear in the rows of a key: time is cut into blocks as long as the window.
    Each row goes to its own block, and a copy with key, time and value only to the
    block after, one window later.  There a running aggregate forwards over the rows and one
    backwards over the copies make up the frame, in one scan and one shuffle.  A task holds the rows of one (key, block) for
    sorting only.  NaN values are counted but left out of sum and max; rows with
    a null key or time get null statistics.  `bucket_seconds` is no longer needed
    and has no effect.
    """
    span = seconds * MICROS
    valid = F.col(key).isNotNull() & F.col(ts).isNotNull()
    us = F.unix_micros(F.col(ts))
    t = (df.withColumn("_s", _spread(df, valid)).withColumn("_valid", valid)
         .withColumn("_copy", F.explode(F.when(valid, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))))
    later = F.when(F.col("_copy"), F.lit(1)).otherwise(F.lit(0))
    number = _number(df, value)
    t = t.select(*[F.col(c) if c == key else F.when(~F.col("_copy"), F.col(c)).alias(c) for c in df.columns],
                 "_s", "_valid", "_copy", (us + later * F.lit(span)).alias("_at"),
                 F.when(F.col("_valid"), F.floor(us / F.lit(span)).cast("long") + later).alias("_blk"),
                 *[F.when(F.col("_copy") if role == "before" else ~F.col("_copy"), c).alias(f"_{role}_{n}")
                   for role in ("own", "before") for n, c in (("v", F.col(value)), ("x", number))])
    block = Window.partitionBy(key, "_blk", "_s")
    frames = {"own": block.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0),
              "before": block.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)}
    for role, w in frames.items():
        t = t.withColumns({f"_{role}_count": F.count(f"_{role}_v").over(w), f"_{role}_sum": F.sum(f"_{role}_x").over(w),
                           f"_{role}_max": F.max(f"_{role}_x").over(w)})
    both = F.when(F.col("_own_sum").isNull(), F.col("_before_sum")).otherwise(F.col("_own_sum") + F.coalesce("_before_sum", F.lit(0)))
    total = {"count": F.col("_own_count") + F.col("_before_count"), "sum": both, "max": F.greatest("_own_max", "_before_max")}
    return t.where("not _copy").select(*df.columns, *[F.when(F.col("_valid"), c).alias(f"{prefix}{p}") for p, c in total.items()])


def islands(df: DataFrame, key: str, ts: str, max_gap_seconds: float, bucket_seconds: int = 3600,
            tiebreak: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Gaps-and-islands: `island` numbers runs of a key's rows whose
    consecutive gaps are <= max_gap_seconds; `gap_seconds` is the gap to the
    previous row (null for the first)."""
    b = time_bucket(ts, bucket_seconds)
    p = previous_value(df, key, ts, [ts], b, tiebreak, prefix="_prev_", hot_rows=hot_rows, keep_parts=True)
    gap = F.unix_micros(F.col(ts)) - F.unix_micros(F.col(f"_prev_{ts}"))
    p = (p.withColumn("gap_seconds", gap / F.lit(float(MICROS)))
          .withColumn("_start", F.when(F.col("gap_seconds").isNull()
                                       | (F.col("gap_seconds") > max_gap_seconds), 1).otherwise(0))
          .drop(f"_prev_{ts}"))
    r = running_totals(p, key, ts, "_start", b, tiebreak, inclusive=True,
                       sum_name="island", count_name="_n", hot_rows=hot_rows)
    return r.drop("_start", "_n")
