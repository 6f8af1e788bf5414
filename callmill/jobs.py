"""Command line of the four jobs, for ``spark-submit``.

    spark-submit run.py intake  --requests … --raw … --checkpoint … --channels …
    spark-submit run.py daily   --raw … --staging … --quarantine … --work … --checkpoint …
    spark-submit run.py spend   --snapshots … --index … --landed …
    spark-submit run.py refresh --staging … --landed … --channels … --marts …

``--channels`` names JSON lines of ``event_type`` and ``channel_name``; its event types are
the ones the intake accepts.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from callmill.plans import curated, daily, refresh, spend, states
from callmill.session import build_session, configure
from callmill.sources import documents, tables
from callmill.streaming.daily import daily_stream
from callmill.streaming.intake import land_stream, outcomes_of

CHANNEL_MAP_SCHEMA = "event_type string, channel_name string"

LAYOUTS = {"files": documents.FILES, "lines": documents.LINES}


def _channels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANNEL_MAP_SCHEMA).json(path)


def run_intake(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Requests per outcome of this run."""
    before = outcomes_of(spark, args.checkpoint)
    land_stream(
        spark,
        args.requests,
        args.raw,
        args.checkpoint,
        _channels(spark, args.channels),
        LAYOUTS[args.layout],
        args.files_per_batch,
    ).awaitTermination()
    return {outcome: n - before[outcome] for outcome, n in outcomes_of(spark, args.checkpoint).items()}


def run_daily(spark: SparkSession, args: argparse.Namespace) -> None:
    stores = daily.Stores(args.raw, args.staging, args.quarantine, args.work, args.table)
    mode = daily.APPEND if args.append else daily.REBUILD
    daily_stream(
        spark, stores, args.checkpoint, LAYOUTS[args.layout], mode, args.archive, args.files_per_batch, args.take_over
    ).awaitTermination()


def run_spend(spark: SparkSession, args: argparse.Namespace) -> spend.SpendLoad | list[spend.SpendLoad]:
    load = spend.load_missing_spends if args.catch_up else spend.load_latest_spend
    return load(spark, args.snapshots, args.index, args.landed)


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    staging = tables.read_staging(spark, args.staging)
    landed = tables.read_spends(spark, args.landed)
    if args.states:
        renewed = states.renew(spark, args.staging, args.landed, args.states)
        marts_in = states.curate(spark, renewed, _channels(spark, args.channels), args.start, args.end)
    else:
        marts_in = curated.curate(staging, _channels(spark, args.channels), landed, args.start, args.end)
    scope = json.dumps([args.start, args.end, args.staging, args.landed, args.channels])
    return refresh.refresh(spark, marts_in, args.marts, args.force, scope=scope)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    intake = command("intake", run_intake, "requests", "raw", "checkpoint", "channels")
    intake.add_argument("--layout", choices=LAYOUTS, default="files")
    intake.add_argument("--files-per-batch", type=int)
    job = command("daily", run_daily, "raw", "staging", "quarantine", "work", "checkpoint")
    job.add_argument("--layout", choices=LAYOUTS, default="lines")
    job.add_argument("--table", help="catalog table that gets the new partitions")
    job.add_argument("--archive", help="where taken raw files move")
    job.add_argument("--files-per-batch", type=int)
    job.add_argument("--append", action="store_true", help="add rows as they are, without dedup across runs")
    job.add_argument("--take-over", action="store_true", help="ignore the lock of a run that is known to be dead")
    load = command("spend", run_spend, "snapshots", "index", "landed")
    load.add_argument("--catch-up", action="store_true", help="land every date that is not there yet, not the latest alone")
    marts = command("refresh", run_refresh, "staging", "landed", "channels", "marts")
    marts.add_argument("--states", help="folder of per-date partial results: only changed dates are read")
    marts.add_argument("--start", help="first folder date of the bookings, and first day of the companions' spends")
    marts.add_argument("--end", help="last folder date, likewise")
    marts.add_argument("--force", action="store_true", help="also refresh what is younger than a day")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    return args.run(configure(spark) if spark else build_session(), args)
