"""Command line: ``python -m shoplens {offline,realtime,query} ...``."""

from __future__ import annotations

import argparse
import sys

from shoplens.params import DEFAULT_CONDITIONS, Conditions
from shoplens.session import build_session


def _conditions(args) -> Conditions:
    """Fixture runs (``--sf-dir``) default to the fixture conditions; other runs
    to the reference's (no bounds, limit 100).  ``--conditions`` and
    ``--limit`` override."""
    fixture = getattr(args, "sf_dir", None) is not None
    if args.conditions:
        c = Conditions.from_json(args.conditions)
    else:
        c = DEFAULT_CONDITIONS if fixture else Conditions()
    return c.with_(blacklist_limit=args.limit) if args.limit is not None else c


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shoplens")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    p.add_argument("--conditions", default=None, help="JSON condition text (camelCase keys)")
    p.add_argument("--limit", type=int, default=None, help="blacklist clicks per user, ad and day")
    sub = p.add_subparsers(dest="cmd", required=True)

    off = sub.add_parser("offline", help="run Q1-Q6 and write result tables")
    off.add_argument("--sf-dir", help="fixture folder (derive the shop tables from it)")
    off.add_argument("--tables", help="folder of stored shop tables (user_visit_action, ...)")
    off.add_argument("--database", help="catalog database of the shop tables")
    off.add_argument("--out", required=True)

    rt = sub.add_parser("realtime", help="run the ad-click stream jobs")
    rt.add_argument("--lines-dir", help="folder of text files with ad lines")
    rt.add_argument("--kafka-servers")
    rt.add_argument("--topic", default="ads_log")
    rt.add_argument("--root", required=True, help="shared output folder; the same one on every start")
    rt.add_argument("--trigger-seconds", type=float, default=None, help="default: availableNow")
    rt.add_argument("--max-files", type=int, default=None, help="text files a micro-batch reads at most")
    rt.add_argument("--max-offsets", type=int, default=None, help="Kafka records a micro-batch reads at most")
    rt.add_argument("--state-partitions", type=int, default=None, help="state stores per stateful query, fixed at the first start")
    rt.add_argument("--write-files", type=int, default=None, help="files a micro-batch writes at most per table")
    rt.add_argument("--counter-days", type=int, default=None, help="days the click counters are kept; default for ever")
    rt.add_argument("--sliding-hour", action="store_true", help="also run the sliding last hour")

    q = sub.add_parser("query", help="show one registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--rows", type=int, default=20)

    args = p.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=None if not args.master else 8)
    c = _conditions(args)

    if args.cmd == "offline":
        from shoplens.plans.offline import parquet_sink, run_offline
        from shoplens.sources.tables import FixtureTables, StoredTables

        if not (args.sf_dir or args.tables or args.database):
            p.error("offline needs --sf-dir, --tables or --database")
        tables = FixtureTables(spark, args.sf_dir) if args.sf_dir else StoredTables(spark, args.tables, args.database)
        print(run_offline(tables, c, parquet_sink(args.out)))
    elif args.cmd == "realtime":
        from shoplens.sources.adlog import read_ad_stream, read_kafka_ad_stream
        from shoplens.streaming.pipeline import AdsStreamJob
        from shoplens.streaming.realtime import run_realtime

        lines = (read_kafka_ad_stream(spark, args.kafka_servers, args.topic, max_offsets_per_trigger=args.max_offsets)
                 if args.kafka_servers else read_ad_stream(spark, args.lines_dir, args.max_files))
        trig = {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else None
        job = AdsStreamJob(spark, root=args.root, limit=c.blacklist_limit, trigger=trig,
                           state_partitions=args.state_partitions, write_files=args.write_files, counter_days=args.counter_days)
        run_realtime(job, lines, sliding_hour=args.sliding_hour)
        if trig:
            spark.streams.awaitAnyTermination()
    else:
        from shoplens.plans.queries import registry

        registry()[args.name](spark, args.sf_dir, c).show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
