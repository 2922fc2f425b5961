"""The jobs as programs to submit: `spark-submit --py-files tidemark.zip jobs.py <job> ...`.

    publish   a table of bronze rows as JSON lines into a landing folder
    ingest    a landing folder into bronze and quarantine, until stopped or what is there
    hourly    silver of the lookback window, then every gold metric
    mart      gold into the marts of a database
    register  catalog entries over the lake's folders
    vacuum    old snapshots of silver and gold

Each prints one JSON object of what it did and ends with status 1 if it failed. A job that is
run again gives the same tables.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.functions.times import as_utc
from tidemark.plans import hourly
from tidemark.session import configure
from tidemark.sources import lake as tables
from tidemark.sources import mart, snapshots, stream
from tidemark.sources.lake import Lake
from tidemark.streaming.ingest import ingest


def _lake(args: argparse.Namespace) -> Lake:
    return Lake(args.root, args.padded, args.database, args.snapshots)


def publish_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    rows = tables.read_bronze(spark, _lake(args))
    stream.publish_files(rows, args.landing)
    return {"landing": args.landing}


def ingest_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    counts = {"batches": 0, "accepted": 0, "rejected": 0}

    def report(batch: dict) -> None:
        counts["batches"] += 1
        for outcome in ("accepted", "rejected"):
            counts[outcome] += batch[outcome]

    raw = stream.read_landing(
        spark, args.landing, args.max_files, max_bytes_per_trigger=args.max_bytes
    )
    query = ingest(raw, _lake(args), args.checkpoint, once=args.once, report=report)
    query.awaitTermination()
    return counts


def hourly_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    lookback = None if args.whole_history else args.lookback_hours
    as_of = as_utc(args.as_of)
    settled = {"leave_out_settled": args.leave_out_settled, "horizon_days": args.horizon_days}
    counts = {"silver": hourly.run_silver(spark, _lake(args), as_of, lookback, **settled)}
    if args.sketches:
        counts["sketches"] = hourly.run_sketches(spark, _lake(args), as_of, lookback)
    gold = hourly.run_gold(spark, _lake(args), as_of)
    return {"as_of": as_of.isoformat(), **counts, **{f"gold_{m}": n for m, n in gold.items()}}


def mart_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    return {"marts": mart.load_all(spark, _lake(args), args.mart_database, args.location)}


def register_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables.register_tables(spark, _lake(args), args.database)
    return {"database": args.database}


def vacuum_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    bases = {"silver": _lake(args).silver, "gold": f"{args.root}/gold"}
    return {
        name: len(snapshots.vacuum(spark, base, args.keep, args.older_than_hours))
        for name, base in bases.items()
    }


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__.partition("\n")[0])
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *needed: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name)
        made.set_defaults(run=run)
        made.add_argument("--root", required=True, help="the lake's folder or URL")
        made.add_argument("--padded", action="store_true", help="folders named month=07")
        made.add_argument("--snapshots", action="store_true", help="silver and gold as snapshots")
        made.add_argument("--database", required="database" in needed, help="catalog database")
        return made

    publish = job("publish", publish_job)
    publish.add_argument("--landing", required=True)

    landed = job("ingest", ingest_job)
    landed.add_argument("--landing", required=True)
    landed.add_argument("--checkpoint", required=True)
    landed.add_argument("--once", action="store_true", help="take what is there and stop")
    landed.add_argument("--max-files", type=int, default=stream.FILES_PER_TRIGGER)
    landed.add_argument("--max-bytes", help="of a batch, 512m say; goes before --max-files")

    batch = job("hourly", hourly_job)
    batch.add_argument("--as-of", type=datetime.fromisoformat, help="UTC; now where not given")
    batch.add_argument("--lookback-hours", type=int, default=hourly.LOOKBACK_HOURS)
    batch.add_argument("--whole-history", action="store_true", help="refine all of bronze")
    batch.add_argument("--leave-out-settled", action="store_true")
    batch.add_argument("--horizon-days", type=int)
    batch.add_argument("--sketches", action="store_true", help="users of each hour as sketches")

    loaded = job("mart", mart_job)
    loaded.add_argument("--mart-database", default="default")
    loaded.add_argument("--location")

    job("register", register_job, "database")

    old = job("vacuum", vacuum_job)
    old.add_argument("--keep", type=int, default=2)
    old.add_argument("--older-than-hours", type=float, default=24)
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    spark = configure(SparkSession.builder.appName(f"tidemark {args.job}").getOrCreate())
    try:
        print(json.dumps({"job": args.job, **args.run(spark, args)}, default=str))
    except Exception as error:  # the status tells a scheduler, the text a person
        print(f"{args.job} failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
