"""Command line for the pipeline's entry points.

    python -m vigil detect    --source kafka --servers H:P --topic T  --lake L --flagged F
    python -m vigil detect    --source files --path DIR               --lake L --flagged F [--once]
                              [--quarantine Q] [--late D] [--unique]
    python -m vigil alerts    --source files --path DIR --out O [--once]
    python -m vigil score-trailing --lake L --out O [--day YYYY-MM-DD ...]
    python -m vigil expire    [--table T ...] [--store L ...] [--keep N] [--grace-days D]
    python -m vigil compact   --flagged F --table T
    python -m vigil compact-lake --lake L --day YYYY-MM-DD ...
    python -m vigil reconcile --lake L --table T [--day YYYY-MM-DD ...]
    python -m vigil load-loans --csv C --snapshot S --table T
    python -m vigil load-rates --payloads P --lake L --table T --source-url U
    python -m vigil warehouse --flagged T1 --summary T2 --loans T3 --rates T4 --out O

The master and cluster settings come from spark-submit; checkpoints go to
the shared `spark.checkpoint.dir` unless --checkpoint is given.
"""

from __future__ import annotations

import argparse

from vigil.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="vigil")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("detect")
    d.add_argument("--source", choices=["kafka", "files"], default="kafka")
    d.add_argument("--servers")
    d.add_argument("--topic", default="transactions.raw")
    d.add_argument("--path")
    d.add_argument("--lake", required=True)
    d.add_argument("--flagged", required=True)
    d.add_argument("--checkpoint")
    d.add_argument("--unique", action="store_true", help="drop repeated deliveries of an id within the watermark")
    d.add_argument("--quarantine", help="messages that cannot be scored (default: beside the lake)")
    d.add_argument("--late", help="rows behind the watermark go here instead of being scored")
    d.add_argument("--trigger", default="30 seconds")
    d.add_argument("--once", action="store_true", help="process what is available, then stop")
    c = sub.add_parser("compact")
    c.add_argument("--flagged", required=True)
    c.add_argument("--table", required=True)
    al = sub.add_parser("alerts")
    for a in ("servers", "path", "checkpoint"):
        al.add_argument(f"--{a}")
    al.add_argument("--source", choices=["kafka", "files"], default="kafka")
    al.add_argument("--topic", default="transactions.raw")
    al.add_argument("--out", required=True)
    al.add_argument("--window-seconds", type=int, default=300)
    al.add_argument("--per-trigger", type=int, default=1_000_000, help="offsets (Kafka) or files a trigger")
    al.add_argument("--trigger", default="30 seconds")
    al.add_argument("--once", action="store_true")
    st = sub.add_parser("score-trailing")
    st.add_argument("--lake", required=True)
    st.add_argument("--day", action="append")
    st.add_argument("--out", required=True)
    ex = sub.add_parser("expire")
    ex.add_argument("--table", action="append", default=[])
    ex.add_argument("--store", action="append", default=[], help="lake, flagged, late or quarantine folder")
    ex.add_argument("--keep", type=int, default=3, help="versions of a table that stay")
    ex.add_argument("--grace-days", type=float, default=7)
    cl = sub.add_parser("compact-lake")
    cl.add_argument("--lake", required=True)
    cl.add_argument("--day", action="append", required=True)
    r = sub.add_parser("reconcile")
    r.add_argument("--lake", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--day", action="append")
    lo = sub.add_parser("load-loans")
    lo.add_argument("--csv", required=True)
    lo.add_argument("--snapshot", required=True)
    lo.add_argument("--table", required=True)
    ra = sub.add_parser("load-rates")
    ra.add_argument("--payloads", required=True)
    ra.add_argument("--lake", required=True)
    ra.add_argument("--table", required=True)
    ra.add_argument("--source-url", required=True)
    w = sub.add_parser("warehouse")
    for a in ("flagged", "summary", "loans", "rates", "out"):
        w.add_argument(f"--{a}", required=True)
    args = p.parse_args(argv)

    spark = build_session(app=f"vigil-{args.cmd}")
    if args.cmd == "detect":
        from vigil.sources.transactions import file_source, kafka_source, parse_transactions
        from vigil.streaming.detector import start_detector
        raw = (kafka_source(spark, args.servers, args.topic) if args.source == "kafka"
               else file_source(spark, args.path))
        stream = parse_transactions(raw)
        if args.unique:
            from pyspark.sql import functions as F
            from vigil.sources.transactions import CORRUPT_COLUMN
            from vigil.streaming.windows import dedup_stream, with_watermark
            # broken messages have no id: they are told apart by their text, so that none is lost
            one = F.coalesce("transaction_id", F.sha2(CORRUPT_COLUMN, 256))
            stream = dedup_stream(with_watermark(stream.withColumn("_delivery", one)), "_delivery").drop("_delivery")
        trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
        start_detector(spark, stream, args.lake, args.flagged, args.checkpoint, trigger,
                       quarantine_root=args.quarantine or f"{args.lake.rstrip('/')}-quarantine",
                       late_root=args.late).awaitTermination()
    elif args.cmd == "alerts":
        from vigil.sources.transactions import file_source, kafka_source, parse_transactions
        from vigil.session import checkpoint_root
        from vigil.streaming.alerts import rapid_fire_alerts
        from vigil.streaming.windows import with_watermark
        raw = (kafka_source(spark, args.servers, args.topic, maxOffsetsPerTrigger=str(args.per_trigger))
               if args.source == "kafka" else file_source(spark, args.path, args.per_trigger))
        found = rapid_fire_alerts(with_watermark(parse_transactions(raw)), args.window_seconds)
        (found.writeStream.format("parquet").option("path", args.out)
         .option("checkpointLocation", args.checkpoint or f"{checkpoint_root(spark)}/alerts")
         .trigger(**({"availableNow": True} if args.once else {"processingTime": args.trigger})).start().awaitTermination())
    elif args.cmd == "score-trailing":
        from vigil.operators.score import score_trailing
        from vigil.sinks.lake import read_lake
        lake = read_lake(spark, args.lake, args.day)
        kept = [c for c in lake.columns if c not in ("tx_count_5m", "total_amount_5m", "max_amount_5m", "geo_flag",
                                                     "rule_name", "is_fraud_detected", "batch_id")]
        score_trailing(lake.select(*kept)).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "expire":
        from vigil.sinks.retention import expire_parts, expire_versions
        for table in args.table:
            print(table, len(expire_versions(spark, table, args.keep, 86400 * args.grace_days)), "folders removed")
        for store in args.store:
            print(store, len(expire_parts(spark, store, 86400 * args.grace_days)), "folders removed")
    elif args.cmd == "compact-lake":
        from vigil.sinks.lake import compact_day
        for day in args.day:
            print(day, "compacted" if compact_day(spark, args.lake, day) else "left as it is")
    elif args.cmd == "compact":
        from vigil.plans.warehouse import compact_flagged
        print(compact_flagged(spark, args.flagged, args.table))
    elif args.cmd == "reconcile":
        from vigil.plans.ingest import reconcile_days
        print(reconcile_days(spark, args.lake, args.table, args.day))
    elif args.cmd == "load-loans":
        from vigil.plans.ingest import load_loans
        print(load_loans(spark, args.csv, args.snapshot, args.table))
    elif args.cmd == "load-rates":
        from vigil.plans.ingest import load_rates
        print(load_rates(spark, args.payloads, args.lake, args.table, args.source_url))
    elif args.cmd == "warehouse":
        from vigil.plans.warehouse import build_warehouse
        out = build_warehouse(spark, args.flagged, args.summary, args.loans, args.rates, args.out)
        out["test_results"].where("failures > 0").show(truncate=False)


if __name__ == "__main__":
    main()
