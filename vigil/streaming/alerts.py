"""Stateful rapid-fire alerts across micro-batches.

The reference counts an account's events inside one micro-batch, so a burst
split by a trigger boundary is missed.  Here the count is over a true
trailing window of event time, carried across batches in state per account and block of time.

State does not grow with the events of a window.  Time is cut into slots as long as the window, and of each slot
the `threshold - 1` earliest and latest times are kept: a window [t - window, t] ends
in one slot and begins in the one before, so the kept times in it are all of them, or at least `threshold - 1`
(`thin`).  Slots that no window of an on-time event reaches any more (Spark drops events older than the
watermark) are forgotten, and idle state expires through an event-time timeout.

Time is also cut into blocks of `BLOCK_WINDOWS` windows, and accounts are dealt by hash to `BUCKETS` buckets; rows and
state are grouped by (bucket, block), so an account with much of the table is spread over tasks, and the number of
groups does not grow with the accounts.  Events within a window of a block's end also go to the next
block, where they are counted but raise no alerts.  A group's rows of one micro-batch
arrive as several Arrow batches; their accounts, ids and times are gathered, laid out on one line of numbers where each account has
a stretch of its own (`_room`), sorted, and counted for all accounts at once
with vectorised binary search (`chunk_alerts`), so the answer does not depend on
the Arrow batch size, the buckets or the blocks.  Bound the source's trigger (`maxFilesPerTrigger`, `maxBytesPerTrigger`,
`maxOffsetsPerTrigger`): a task gathers one micro-batch's rows of a group.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigil.functions.rules import RAPID_FIRE_COUNT_THRESHOLD

ALERT_SCHEMA = "nameOrig string, transaction_id string, event_time timestamp"
#: The kept times of a bucket's accounts: how many each has, and all of them (microseconds) in a row.
STATE_SCHEMA = "accounts array<string>, sizes array<bigint>, times array<bigint>"
#: Width of a block of time in windows: one event in so many goes to two blocks.
BLOCK_WINDOWS = 8
#: Groups of accounts that are counted together. State is kept by bucket: a checkpoint holds for one number of them.
BUCKETS = 256
#: Largest number on the line of a group's times; accounts beyond it are counted in another round.
LINE_END = 1 << 62


def chunk_alerts(times: np.ndarray, new: np.ndarray, window: int, threshold: int):
    """Count one chunk of an account's events against its trailing window.

    `times`: sorted event times seen so far (int64 microseconds); `new`: the
    chunk's times, sorted (ties in transaction-id order).  Event i counts the
    earlier events in [t_i - window, t_i]: those in `times` plus chunk events
    before it.  Returns (alert mask: count + itself >= threshold, merged
    sorted times).  O((|times| + |new|) log) with numpy, no Python per row.
    """
    lo = new - window
    from_seen = np.searchsorted(times, new, "right") - np.searchsorted(times, lo, "left")
    from_chunk = np.arange(len(new)) - np.searchsorted(new, lo, "left")
    alert = from_seen + from_chunk + 1 >= threshold
    merged = np.concatenate([times, new])
    merged.sort(kind="mergesort")
    return alert, merged


def thin(times: np.ndarray, window: int, keep: int) -> np.ndarray:
    """Of sorted times, the `keep` earliest and latest of each slot of `window` length.

    Any window [t - window, t] holds either the same number of them as of all times, or at least `keep`.
    """
    slot = times // max(window, 1)
    first, last = np.searchsorted(slot, slot, "left"), np.searchsorted(slot, slot, "right")
    place = np.arange(len(times))
    return times[(place - first < keep) | (last - place <= keep)]


def _micros(values) -> np.ndarray:
    return pd.to_datetime(pd.Series(values)).values.astype("datetime64[us]").astype("int64")


def _room(width: int, window: int) -> int:
    """Stretch of an account on its group's line: a block, the window before it, and a window that stays empty."""
    return width + 2 * max(window, 1)


def _stored(state: GroupState) -> tuple[list, np.ndarray, np.ndarray]:
    """The accounts in the state, and the account's number and time of each kept event."""
    if not state.exists:
        return [], np.empty(0, dtype="int64"), np.empty(0, dtype="int64")
    accounts, sizes, times = state.get
    return list(accounts), np.repeat(np.arange(len(accounts)), np.array(sizes, dtype="int64")), np.array(times, dtype="int64")


def rapid_fire_alerts(stream: DataFrame, window_seconds: int = 300,
                      threshold: int = RAPID_FIRE_COUNT_THRESHOLD,
                      account: str = "nameOrig", block_windows: int = BLOCK_WINDOWS, buckets: int = BUCKETS) -> DataFrame:
    """Emit one alert row per event that brings its account's trailing
    `window_seconds` count to >= threshold (the stream needs a watermark)."""
    window = int(window_seconds) * 1_000_000
    width = max(window, 1_000_000) * block_windows
    room = _room(width, window)
    at_once = max(1, LINE_END // room)

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        wm = int(state.getCurrentWatermarkMs()) * 1000
        origin = int(key[1]) - max(window, 1)
        known, old, old_times = _stored(state)
        # chunks are a matter of the Arrow batch size: they are joined and sorted
        # first (account, id and time only), so alerts do not depend on it
        chunks = [pdf.dropna(subset=["event_time"])[["nameOrig", "transaction_id", "event_time", "_own"]] for pdf in batches]
        pdf = pd.concat(chunks, ignore_index=True) if chunks else pd.DataFrame({c: [] for c in ("nameOrig", "transaction_id", "event_time", "_own")})
        # null is an account like any other
        codes, names = pd.factorize(np.array(known + pdf["nameOrig"].tolist(), dtype=object), use_na_sentinel=False)
        old, codes = codes[:len(known)][old], codes[len(known):]
        times, own = _micros(pdf["event_time"]), pdf["_own"].to_numpy(dtype=bool)
        hits, kept_codes, kept_times = [], [], []
        for low in range(0, len(names), at_once):
            def line(number, time, low=low):
                return (number - low) * room + (time - origin)
            stored, here = (old >= low) & (old < low + at_once), (codes >= low) & (codes < low + at_once)
            # events of the block before come before all of this block's
            before = here & ~own
            seen = np.sort(np.concatenate([line(old[stored], old_times[stored]), line(codes[before], times[before])]))
            rows = pdf.loc[here & own].assign(_at=line(codes[here & own], times[here & own]))
            rows = rows.sort_values(["_at", "transaction_id"] if rows["_at"].duplicated().any() else "_at")
            alert, seen = chunk_alerts(seen, rows["_at"].to_numpy(dtype="int64"), window, threshold)
            hits.append(rows.loc[alert, ["nameOrig", "transaction_id", "event_time"]])
            seen = thin(seen[seen % room + origin >= wm - window], window, threshold - 1)
            kept_codes.append(seen // room + low)
            kept_times.append(seen % room + origin)
        kept = np.concatenate(kept_times) if kept_times else old_times
        end = min(int(kept.max()) + window, int(key[1]) + width) if len(kept) else wm
        if end > wm:
            # each account's times are in a row
            present, sizes = np.unique(np.concatenate(kept_codes), return_counts=True)
            state.update(([None if pd.isna(names[k]) else names[k] for k in present.tolist()], sizes.tolist(), kept.tolist()))
            state.setTimeoutTimestamp(end // 1000)
        elif state.exists:
            state.remove()
        yield from (h for h in hits if len(h))

    micros = F.unix_micros("event_time")
    start = micros - F.pmod(micros, F.lit(width))
    blocks = F.when(micros >= start + width - window, F.array(start, start + width)).otherwise(F.array(start))
    return (stream.where(F.col("event_time").isNotNull())
            .select(F.col(account).cast("string").alias("nameOrig"), "transaction_id", "event_time", F.explode(blocks).alias("_block"))
            .withColumn("_own", F.col("_block") <= F.unix_micros("event_time"))
            .withColumn("_bucket", F.pmod(F.xxhash64("nameOrig"), F.lit(buckets)))
            .groupBy("_bucket", "_block")
            .applyInPandasWithState(step, ALERT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.EventTimeTimeout))
