"""The streaming fraud detector (W4-W7): parse -> score -> lake + serving.

One streaming query with `foreachBatch`.  Each micro-batch is persisted
once, scored with the same `score()` a lake replay uses (statistics per
micro-batch, as the reference computes them), then written to

* the lake (K1), all scored rows by day, and
* the serving store (K2), flagged rows,
* where their folders are given, a quarantine of messages that cannot be scored, and a store of late
  rows with their lag behind the watermark (W4: what Spark's stateful operators would drop without a trace).

All parts of a batch become visible together: the markers of the other stores name the lake's, which is
created last (`sinks.lake`).  A kill between two writes shows none of them, and a batch
replayed after a failure replaces its own output (exactly-once results on an
at-least-once sink).  Row counts come from `observe` (A11): no extra job.
Write errors propagate and fail the batch instead of being swallowed.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil.functions.rules import RuleSet, default_rules
from vigil.operators.score import flagged, score, to_serving
from vigil.schemas import FLAGGED, RAW, conform, misfits
from vigil.session import checkpoint_root
from vigil.sinks.lake import commit_batch, last_commit, stage_batch
from vigil.sources.transactions import CORRUPT_COLUMN

log = logging.getLogger(__name__)

#: W1's tolerance: ten minutes behind the newest event.
LATE_AFTER = 600


@dataclass
class BatchMetrics:
    """Per-batch counts collected through `Observation`."""
    history: list[dict] = field(default_factory=list)


#: Stream columns that the serving tables hold under other names.
SERVED_AS = {"oldbalanceOrg": "old_balance_orig", "newbalanceOrig": "new_balance_orig",
             "oldbalanceDest": "old_balance_dest", "newbalanceDest": "new_balance_dest"}


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to score, rows set aside).

    Set aside are messages whose JSON failed to parse (reason `corrupt`, text in
    `message`) and events with a value that no serving table can hold (reason: the
    columns).  One such event would otherwise fail its micro-batch on every retry.
    """
    reason = misfits(parsed, RAW, SERVED_AS)
    text = F.lit(None).cast("string")
    if CORRUPT_COLUMN in parsed.columns:
        text = F.col(CORRUPT_COLUMN)
        reason = F.when(text.isNotNull(), F.lit("corrupt")).otherwise(reason)
    marked = parsed.withColumn("reason", reason)
    good = marked.where(F.col("reason").isNull()).drop("reason", CORRUPT_COLUMN)
    return good, marked.where(F.col("reason").isNotNull()).withColumn("message", text).drop(CORRUPT_COLUMN)


def split_late(batch: DataFrame, watermark_micros: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows on time, rows behind the watermark with `lag_seconds`); rows without an event time are on time."""
    lag = (F.lit(watermark_micros).cast("long") - F.unix_micros("event_time")) / 1e6
    marked = batch.withColumn("lag_seconds", lag)
    late = F.coalesce(F.col("lag_seconds") > 0, F.lit(False))
    return marked.where(~late).drop("lag_seconds"), marked.where(late)


def make_batch_writer(lake_root: str, flagged_root: str, rules: RuleSet | None = None,
                      metrics: BatchMetrics | None = None, quarantine_root: str | None = None,
                      late_root: str | None = None, late_after_seconds: int = LATE_AFTER):
    """Writer of one micro-batch.

    With `quarantine_root`, rows set aside by `quarantine` go there; without it they are scored as
    they are, and values that do not fit become null in the serving table.  With `late_root`, rows more than
    `late_after_seconds` behind the newest event of all earlier batches go there and are not
    scored.  Every row ends up in exactly one of lake, quarantine and late store.
    """
    rules = rules or default_rules()

    def process_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        obs = Observation(f"batch_{batch_id}")
        token = uuid.uuid4().hex[:16]
        # the newest event so far travels from marker to marker
        earlier = (last_commit(spark, lake_root, batch_id) or {}).get("newest_micros")
        parsed = batch.persist() if quarantine_root or late_root else batch
        beside = []
        try:
            if quarantine_root:
                batch, aside = quarantine(batch)
                beside.append((quarantine_root, stage_batch(aside, quarantine_root, batch_id, False, token)))
            if late_root:
                batch, late = split_late(batch, None if earlier is None else earlier - late_after_seconds * 1_000_000)
                beside.append((late_root, stage_batch(late, late_root, batch_id, False, token)))
            scored = score(batch, rules, batch_cols=())
            scored = scored.observe(obs, F.count(F.lit(1)).alias("rows"),
                                    F.count_if(F.col("is_fraud_detected")).alias("flagged"),
                                    F.max(F.unix_micros("event_time")).alias("newest_micros"))
            scored = scored.persist()
            try:
                whole = stage_batch(scored, lake_root, batch_id, True, token)
                serving = conform(to_serving(flagged(scored)), FLAGGED)
                beside.append((flagged_root, stage_batch(serving, flagged_root, batch_id, False, token)))
                m = dict(obs.get)
            finally:
                scored.unpersist()
        finally:
            if quarantine_root or late_root:
                parsed.unpersist()
        newest = [x for x in (earlier, m.pop("newest_micros", None)) if x is not None]
        for root, content in beside:
            commit_batch(spark, root, {**content, "with": lake_root})
        commit_batch(spark, lake_root, {**whole, **m, "newest_micros": max(newest, default=None)})
        log.info("batch %d: %s rows, %s flagged", batch_id, m.get("rows"), m.get("flagged"))
        if metrics is not None:
            metrics.history.append({"batch_id": batch_id, **m})

    return process_batch


def start_detector(spark: SparkSession, parsed_stream: DataFrame, lake_root: str, flagged_root: str,
                   checkpoint: str | None = None, trigger: dict | None = None,
                   rules: RuleSet | None = None, metrics: BatchMetrics | None = None,
                   quarantine_root: str | None = None, late_root: str | None = None,
                   late_after_seconds: int = LATE_AFTER):
    """W5 + W6: start the scoring query; checkpoints default to the shared
    `spark.checkpoint.dir`.  `trigger` e.g. {"processingTime": "30 seconds"}
    (the reference's cadence) or {"availableNow": True} for catch-up runs."""
    ckpt = checkpoint or f"{checkpoint_root(spark)}/fraud-detector"
    w = (parsed_stream.writeStream
         .foreachBatch(make_batch_writer(lake_root, flagged_root, rules, metrics, quarantine_root, late_root, late_after_seconds))
         .option("checkpointLocation", ckpt))
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return w.start()


def replay(lake: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Re-score the lake with (new) rules; each stored micro-batch is a
    statistics group, so results match what the stream computed."""
    base = lake.drop("tx_count_5m", "total_amount_5m", "max_amount_5m", "geo_flag",
                     "rule_name", "is_fraud_detected")
    return score(base, rules or default_rules(), batch_cols=("batch_id",))
