"""Command line: ``spark-submit`` or ``python -m tripflow <job> ...``."""

from __future__ import annotations

import argparse
import os

from tripflow.operators import regression
from tripflow.operators.align import lower_names
from tripflow.plans import jobs
from tripflow.session import build_session, size_shuffles
from tripflow.sources import files, relational, tables
from tripflow.streaming import messages


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tripflow")
    root.add_argument("--master", help="left out under spark-submit")
    sub = root.add_subparsers(dest="job", required=True)

    report = sub.add_parser("monthly-report", help="monthly revenue by zone id")
    union = sub.add_parser("union-services", help="stored union of both services")
    marts = sub.add_parser("build-marts", help="staging, dimension, fact, mart and checks")
    for job in (report, union, marts):
        job.add_argument("--input_green", required=True, nargs="+")
        job.add_argument("--input_yellow", required=True, nargs="+")
        job.add_argument("--output", required=True)
    union.add_argument("--files", type=int, help="fixed number of output files")
    marts.add_argument("--zones", required=True, help="zone lookup CSV")
    marts.add_argument("--tables_prefix", help="also register tables, e.g. marts.")

    produce = sub.add_parser("produce", help="rows as JSON messages in text files")
    produce.add_argument("--input", required=True, nargs="+")
    produce.add_argument("--output", required=True)

    distances = sub.add_parser("zone-distances", help="trip distances with zone names")
    distances.add_argument("--trips", required=True, nargs="+")
    distances.add_argument("--zones", required=True)
    distances.add_argument("--output", required=True)
    distances.add_argument("--files", type=int)

    dated = sub.add_parser("load-dated", help="files to a date-partitioned table")
    dated.add_argument("--source", required=True)
    dated.add_argument("--table", required=True)
    dated.add_argument("--timestamp", required=True)
    dated.add_argument("--cluster_by", nargs="*", default=[])
    dated.add_argument("--path")
    dated.add_argument("--grain", choices=["day", "month"], default="day")
    dated.add_argument(
        "--replace_dates",
        action="store_true",
        help="load into the existing table, in place of the dates the files hold",
    )

    hourly = sub.add_parser("hourly-merge", help="hourly revenue of both services, merged")
    hourly.add_argument("--trips", required=True, nargs="+", help="stored union of services")
    hourly.add_argument("--zones", required=True)
    hourly.add_argument("--output", required=True)

    tips = sub.add_parser("tip-model", help="train, evaluate and save the tip model")
    tips.add_argument("--trips", required=True, nargs="+")
    tips.add_argument("--key", required=True, nargs="+", help="columns that identify a trip")
    tips.add_argument("--output", required=True)

    stream = sub.add_parser("consume", help="JSON topic to files; malformed messages apart")
    for name in ("servers", "topic", "output", "checkpoint"):
        stream.add_argument(f"--{name}", required=True)
    stream.add_argument("--group")
    stream.add_argument("--messages_at_once", type=int, help="bound of a micro-batch")
    stream.add_argument("--once", action="store_true", help="drain the topic and stop")

    ingest = sub.add_parser("ingest", help="files to a relational table")
    ingest.add_argument("--input", required=True, nargs="+")
    for name in ("user", "host", "port", "db", "table_name"):
        ingest.add_argument(f"--{name}", required=True)
    ingest.add_argument("--password", help="default: environment variable DB_PASSWORD")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tripflow {args.job}", args.master)
    named = ("input_green", "input_yellow", "trips", "input")
    inputs = [path for name in named for path in getattr(args, name, None) or []]
    if inputs:
        size_shuffles(spark, files.stored_bytes(spark, *inputs))
    if args.job == "monthly-report":
        jobs.monthly_report(spark, args.input_green, args.input_yellow, args.output)
    elif args.job == "union-services":
        jobs.union_services(spark, args.input_green, args.input_yellow, args.output, args.files)
    elif args.job == "build-marts":
        built = jobs.build_marts_from_files(
            spark,
            args.input_green,
            args.input_yellow,
            args.zones,
            args.output,
            tables_prefix=args.tables_prefix,
        )
        built.report.show(truncate=False)
    elif args.job == "zone-distances":
        trips = files.read_parquet(spark, *args.trips)
        zones = files.read_parquet(spark, args.zones)
        jobs.zone_distances(trips, zones, args.output, args.files)
    elif args.job == "hourly-merge":
        trips = files.read_parquet(spark, *args.trips)
        jobs.hourly_merge(trips, files.read_parquet(spark, args.zones), args.output)
    elif args.job == "tip-model":
        trips = lower_names(files.read_parquet(spark, *args.trips))
        key = {c.lower(): trips.schema[c.lower()].dataType for c in args.key}
        run = jobs.tip_model(trips, key)
        run.model.save(args.output)
        jobs.explained_tips(run, args.output)
        regression.evaluate(run.model, run.held_out).show(truncate=False)
    elif args.job == "consume":
        source = messages.read_topic(
            spark, args.servers, args.topic, args.group, args.messages_at_once
        )
        jobs.consume(source, args.output, args.checkpoint, once=args.once).awaitTermination()
    elif args.job == "produce":
        jobs.produce(files.read_parquet(spark, *args.input), args.output)
    elif args.job == "load-dated":
        size_shuffles(spark, files.stored_bytes(spark, args.source))
        cluster_by = tuple(args.cluster_by)
        if args.replace_dates:
            table = tables.DatedTable(
                args.table, args.timestamp, grain=args.grain, cluster_by=cluster_by
            )
            jobs.reload_dates(spark, args.source, table)
        else:
            jobs.load_dated(
                spark, args.source, args.table, args.timestamp, cluster_by, args.path, args.grain
            )
    elif args.job == "ingest":
        options = relational.write_options(
            relational.postgres_url(args.host, args.port, args.db),
            args.table_name,
            {"user": args.user, "password": args.password or os.environ["DB_PASSWORD"]},
        )
        jobs.ingest(spark, args.input, options)


if __name__ == "__main__":
    main()
