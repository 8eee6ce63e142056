"""Measure how a hot key spreads over tasks: naive per-key windows vs vigil's operators.

    python tools/skew_probe.py [sf_dir]

Transactions are derived from `lineitem` with one account holding a third of
the rows (every order key divisible by 3).  Each variant runs through the noop
sink with Spark's event log written to a scratch folder; the largest task's
shuffle-read record count per variant is reported (what one task must hold).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from vigil.operators.dedup import dedup
    from vigil.operators.quantile import exact_percentiles
    from vigil.operators.score import score
    from vigil.operators.sequence import running_totals, time_bucket, trailing_window
    from vigil.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="vigil-eventlog-")
    spark = build_session("local[8]", app="skew-probe", conf={
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    tx = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("C"), F.col("l_suppkey").cast("string"))).alias("nameOrig"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
            secs=(F.col("l_orderkey") % 86400).cast("decimal(8,0)"))).alias("event_time"),
        F.col("l_extendedprice").alias("amount"))

    variants = {
        "naive_window_by_account": lambda: tx.withColumn(
            "n", F.count("amount").over(Window.partitionBy("nameOrig").orderBy(F.unix_micros("event_time"))
                                        .rangeBetween(-300 * 10 ** 6, 0))),
        "trailing_window_bucketed": lambda: trailing_window(tx, "nameOrig", "event_time", "amount", 300,
                                                            bucket_seconds=3600),
        "naive_running_sum_by_account": lambda: tx.withColumn(
            "s", F.sum("amount").over(Window.partitionBy("nameOrig").orderBy("event_time", "transaction_id")
                                      .rowsBetween(Window.unboundedPreceding, -1))),
        "running_totals_bucketed": lambda: running_totals(tx, "nameOrig", "event_time", "amount",
                                                          time_bucket("event_time", 3600), ["transaction_id"]),
        "row_number_dedup_by_account": lambda: tx.withColumn(
            "rn", F.row_number().over(Window.partitionBy("nameOrig").orderBy("event_time"))).where("rn = 1"),
        "aggregate_dedup_by_account": lambda: dedup(tx, "nameOrig", "event_time"),
        "builtin_percentile_by_account": lambda: tx.groupBy("nameOrig").agg(
            F.percentile("amount", [0.01, 0.99]).alias("q")),
        "radix_percentile_by_account": lambda: exact_percentiles(
            tx, ["nameOrig"], "amount", [0.01, 0.99]),
        "naive_count_over_account": lambda: tx.withColumn(
            "tx_count_5m", F.count(F.lit(1)).over(Window.partitionBy("nameOrig"))),
        "score_aggregate_then_join": lambda: score(tx.withColumn("anomaly_type", F.lit(None).cast("string")),
                                                   batch_cols=(), hot_rows=10_000),
    }
    # the join must shuffle (no broadcast), and AQE's skew split is scaled down to
    # this data size: at 100 TB the hot partition is far above the 256 MB default
    join_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}
    total = tx.count()
    hot = tx.where("nameOrig = 'HOT'").count()
    for name, build in variants.items():
        spark.sparkContext.setJobGroup(name, name)
        if name.startswith("score"):
            for k, v in join_conf.items():
                spark.conf.set(k, v)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    # parse the event log: max shuffle records read by one task, per job group
    stage_group, worst, worst_bytes = {}, {}, {}
    files = [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        for line in open(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = g
            elif ev == "SparkListenerTaskEnd":
                g = stage_group.get(e["Stage ID"])
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                nbytes = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                if g:
                    worst[g] = max(worst.get(g, 0), recs)
                    worst_bytes[g] = max(worst_bytes.get(g, 0), nbytes)
    print(json.dumps({"rows": total, "hot_account_rows": hot,
                      "max_shuffle_records_per_task": worst,
                      "max_shuffle_bytes_per_task": worst_bytes}, indent=1))


if __name__ == "__main__":
    main()
