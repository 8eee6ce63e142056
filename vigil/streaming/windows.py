"""Event-time operators for Structured Streaming.

The same functions run on a static DataFrame (no watermark needed) and on a
streaming one (`watermark` set), so replay and stream share one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_WATERMARK = "10 minutes"   # W1: lateness the stream tolerates


def with_watermark(df: DataFrame, delay: str = DEFAULT_WATERMARK, event_time: str = "event_time") -> DataFrame:
    """Declare event time and allowed lateness; later rows are dropped by
    every stateful operator downstream (W4)."""
    return df.withWatermark(event_time, delay)


def windowed_stats(df: DataFrame, duration: str = "5 minutes", slide: str | None = None,
                   account: str = "nameOrig", amount: str = "amount",
                   event_time: str = "event_time") -> DataFrame:
    """Count / sum / max per account per tumbling (or sliding) window.

    On a stream with a watermark this runs in append mode: a window is
    emitted once the watermark passes its end, and its state is dropped.
    """
    win = F.window(event_time, duration, slide) if slide else F.window(event_time, duration)
    return (df.groupBy(win.alias("w"), account)
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.sum(amount).alias("total_amount"),
                 F.max(amount).alias("max_amount"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    account, "tx_count", "total_amount", "max_amount"))


def dedup_stream(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Drop repeated deliveries of a key seen within the watermark."""
    return df.dropDuplicatesWithinWatermark([key])
