"""Command line: ``spark-submit`` or ``python -m riskflow <layer>`` with the folders to use."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import uuid
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators.geo import load_places, read_ranges
from riskflow.operators.layout import ROWS_PER_FILE
from riskflow.operators.timelines import VelocityRule
from riskflow.plans import pipeline
from riskflow.session import build_session
from riskflow.sources.feed import MAX_FILE_AGE, good_rows, read_feed
from riskflow.sources.limits import parse_bytes
from riskflow.sources.lookups import BROADCAST_LIMIT_BYTES, SPECS, load_lookups
from riskflow.streaming.layers import TIMELINE_DELAY, Pace, Store

STREAMED = ("bronze", "silver", "gold", "timelines")
TIMELINES = ("velocity", "devices", "lifetime", "amounts")


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskflow", description=__doc__)
    layer = parser.add_subparsers(dest="layer", required=True)
    for name in ("bronze", "silver", "gold", "timelines", "dates", "compact", "layout", "check", "anomalies"):
        job = layer.add_parser(name)
        job.add_argument("--store", required=True, help="root folder of tables and checkpoints")
        if name in STREAMED:
            limit = job.add_mutually_exclusive_group()
            limit.add_argument("--max-files", type=int, help="files per micro-batch")
            limit.add_argument("--max-bytes", type=parse_bytes, help="bytes per micro-batch, such as 500g")
            job.add_argument("--interval", help="keep running, a micro-batch each, such as '1 minute'")
            job.add_argument("--timeout", type=float, help="seconds until the run is given up")
        if name == "bronze":
            job.add_argument("--feed", required=True, help="folder of newline-delimited JSON")
            job.add_argument("--restricted", help="root folder of clear personal data")
            job.add_argument("--keep-pii", action="store_true", help="write the clear-text copy")
            job.add_argument("--no-quarantine", action="store_true",
                             help="count corrupt lines, but leave them to a later run")
            job.add_argument("--one-date-files", action="store_true",
                             help="the feed's files hold one date each: write without a shuffle")
            job.add_argument("--max-file-age", default=MAX_FILE_AGE,
                             help="leave out files older than the newest by more than this")
            job.add_argument("--audit", action="store_true",
                             help="keep the source of each row, and a table of all lines' sources")
            job.add_argument("--repeats-within",
                             help="a transaction sent again within this time, such as '2 days', lands once")
            job.add_argument("--more", help="further keys of the feed to keep, such as 'channel string'")
            job.add_argument("--watch-drift", action="store_true",
                             help="write how each batch's keys and types differ from the declared ones")
            job.add_argument("--geo", help="CSV file of address ranges: network,geo_country,geo_region")
            salt = job.add_mutually_exclusive_group()
            salt.add_argument("--card-salt-file", type=Path, help="file with the salt of card hashes")
            salt.add_argument("--card-salt-env", help="environment variable with the salt")
        if name == "timelines":
            job.add_argument("--only", nargs="+", choices=TIMELINES, default=TIMELINES)
            job.add_argument("--delay", default=TIMELINE_DELAY,
                             help="how far behind the newest event time a transaction may come")
            job.add_argument("--window-seconds", type=int, default=VelocityRule.window_seconds)
            job.add_argument("--limit", type=int, default=VelocityRule.limit,
                             help="transactions in a window that score 100")
        if name in ("silver", "dates"):
            for spec in SPECS:
                job.add_argument(f"--{spec.name.replace('_', '-')}", required=True, help="CSV file")
            job.add_argument("--broadcast-limit", type=parse_bytes, default=BROADCAST_LIMIT_BYTES)
        if name == "dates":
            job.add_argument("--target", required=True, help="folder of the tables of these dates")
            job.add_argument("--from-date", type=dt.date.fromisoformat, required=True)
            job.add_argument("--to-date", type=dt.date.fromisoformat, required=True)
        if name == "silver":
            job.add_argument("--since", type=dt.date.fromisoformat,
                             help="first date in which to look for frequent keys")
            job.add_argument("--join-metrics", action="store_true",
                             help="count each lookup's misses, and their keys by a sketch")
        if name == "compact":
            job.add_argument("--before", type=dt.date.fromisoformat, required=True,
                             help="first date that is left as it is")
        if name == "anomalies":
            job.add_argument("--target", required=True, help="folder of the classes and their shares")
        if name == "layout":
            job.add_argument("--target", required=True, help="folder of the clustered copies")
            job.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
            job.add_argument("--from-date", type=dt.date.fromisoformat, help="first date to rewrite")
            job.add_argument("--to-date", type=dt.date.fromisoformat, help="last date to rewrite")
    args = parser.parse_args()
    if args.layer == "bronze" and not args.restricted and (args.keep_pii or not args.no_quarantine):
        parser.error("--restricted is needed for the quarantine and the clear-text copy")
    return args


def card_salt(args: argparse.Namespace) -> str | None:
    if args.card_salt_file:
        return args.card_salt_file.read_text().strip()
    return os.environ[args.card_salt_env] if args.card_salt_env else None


def dates(args: argparse.Namespace):
    day, found = F.col("event_date"), None
    if args.from_date:
        found = day >= F.lit(args.from_date)
    if args.to_date:
        found = day <= F.lit(args.to_date) if found is None else found & (day <= F.lit(args.to_date))
    return found


def main() -> None:
    args = arguments()
    spark = build_session(f"riskflow-{args.layer}")
    store = Store(args.store, getattr(args, "restricted", None))
    if args.layer in STREAMED:
        pace = Pace(args.max_files, args.max_bytes, args.interval)
    if args.layer == "bronze":
        places = None
        if args.geo:
            places = load_places(read_ranges(spark, args.geo), store.segments(uuid.uuid4().hex),
                                 feed=good_rows(read_feed(spark, args.feed)))
        counts = pipeline.run_bronze(
            spark, args.feed, store, pace, keep_corrupt=not args.no_quarantine,
            keep_pii=args.keep_pii, card_salt=card_salt(args),
            gather_dates=not args.one_date_files, timeout=args.timeout,
            max_file_age=args.max_file_age, places=places, audit=args.audit,
            repeats_within=args.repeats_within, more=T.StructType.fromDDL(args.more) if args.more else T.StructType(),
            watch_drift=args.watch_drift,
        )
        print(f"lines {counts['lines']}, corrupt {counts['corrupt_lines']}")
    elif args.layer in ("silver", "dates"):
        paths = {spec.name: getattr(args, spec.name) for spec in SPECS}
        lookups = load_lookups(spark, paths, args.broadcast_limit)
        if args.layer == "silver":
            pipeline.run_silver(spark, store, lookups, pace, timeout=args.timeout, since=args.since,
                                metrics=args.join_metrics)
        else:
            pipeline.run_dates(spark, store, lookups, args.target, args.from_date, args.to_date)
    elif args.layer == "gold":
        pipeline.run_gold(spark, store, pace, args.timeout)
    elif args.layer == "timelines":
        rule = VelocityRule(args.window_seconds, args.limit,
                            max(args.window_seconds, VelocityRule.stretch_seconds))
        pipeline.run_timelines(spark, store, pace, args.timeout, rule, args.delay, tuple(args.only))
    elif args.layer == "compact":
        pipeline.run_compact(spark, store, args.before)
    elif args.layer == "anomalies":
        pipeline.run_anomalies(spark, store, args.target)
    elif args.layer == "check":
        wrong = [rows.where("status != 'same'") for rows in pipeline.check_layers(spark, store)]
        for rows in wrong:
            rows.orderBy("event_date", "layer").show(1000, truncate=False)
        if not all(rows.isEmpty() for rows in wrong):
            raise SystemExit("layers differ")
    else:
        pipeline.run_layout(spark, store, args.target, args.rows_per_file, dates(args))


if __name__ == "__main__":
    main()
