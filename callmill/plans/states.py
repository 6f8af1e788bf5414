"""Per-date partial results of the marts, renewed for the dates whose stored rows have changed.

Of every folder date the bookings per hour, the meeting days and members of its events, and the spellings of employee names are
kept; of every landed spend date the sums per channel. The marts are built on the union of these. A pointer file
names the folders that count and what each was made from: the parts of the staging table's manifest, or the landed files as they are
listed. A refresh reads the dates alone for which that differs, and switches the pointer in one step.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.operators.fanout import channel_totals, hourly_counts
from callmill.plans import curated
from callmill.plans.marts import BOOKED, MEETING, Curated
from callmill.schemas import PARTITION, STAGING_SCHEMA
from callmill.sources import files, tables, versions
from callmill.sources.versions import VERSION

CURRENT = "_current.json"
SPEND_DATE = "file_date"

HOURS, DAYS, MEMBERS, NAMES, SPENDS = "hours", "days", "members", "names", "spends"
KINDS = {
    HOURS: f"event_type string, {BOOKED} timestamp, {MEETING} timestamp, ids bigint, rows bigint, counted_by string",
    DAYS: f"event_id string, {MEETING} timestamp",
    MEMBERS: "event_id string, employee_id string",
    NAMES: "employee_id string, employee_name string, seen timestamp",
    SPENDS: "channel string, channel_spend decimal(38,2), spend_rows bigint",
}


@dataclass(frozen=True)
class States:
    """What the pointer says: for each date its source, its version, and the kinds that have rows."""

    root: str
    bookings: dict[str, dict]
    spends: dict[str, dict]
    renewed: list[str]

    def read(self, spark: SparkSession, kind: str, dates: list[str] | None = None) -> DataFrame:
        entries = self.spends if kind == SPENDS else self.bookings
        column = SPEND_DATE if kind == SPENDS else PARTITION
        schema = T.StructType.fromDDL(KINDS[kind])
        base = f"{self.root}/{kind}"
        paths = [
            f"{base}/{VERSION}={entry['version']}/{column}={files.escaped(spark, date)}"
            for date, entry in sorted(entries.items())
            if kind in entry["kinds"] and (dates is None or date in dates)
        ]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.option("basePath", base).schema(schema).parquet(*paths).select(*schema.names)


def _print(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def _landed(spark: SparkSession, path: str) -> dict[str, str]:
    """For each landed spend date what its files are."""
    found = {}
    for folder in files.child_folders(spark, path):
        name, _, date = folder.rsplit("/", 1)[1].partition("=")
        if name == SPEND_DATE:
            found[tables.unquote(date)] = _print(files.listed(spark, folder))
    return found


def _write(spark: SparkSession, root: str, kind: str, version: str, rows: DataFrame, column: str) -> set[str]:
    """Write a kind's rows of the changed dates; returns the dates that have some."""
    place = f"{root}/{kind}/{VERSION}={version}"
    rows.hint("rebalance", column).write.partitionBy(column).parquet(place)
    return {tables.unquote(path.rsplit("=", 1)[1]) for path in files.child_folders(spark, place)}


def _booking_kinds(rows: DataFrame) -> dict[str, DataFrame]:
    dated = curated.bookings(rows, PARTITION)
    return {
        HOURS: hourly_counts(dated, [BOOKED, MEETING], PARTITION),
        DAYS: dated.where(F.col("event_id").isNotNull())
        .select(PARTITION, "event_id", F.to_date(MEETING).cast("timestamp").alias(MEETING))
        .distinct(),
        MEMBERS: curated.memberships(rows, PARTITION).distinct(),
        NAMES: curated.spellings(rows, PARTITION),
    }


def renew(spark: SparkSession, staging: str, landed: str, root: str) -> States:
    """Bring the partial results up to the last state of the staging table and the landed spends.

    Repeating it reads nothing. A date that is gone from its source is gone from the results.
    """
    root = root.rstrip("/")
    old = json.loads(files.read_text(spark, f"{root}/{CURRENT}") or '{"bookings": {}, "spends": {}}')
    state = versions.current(spark, staging)
    made_of = {
        "bookings": {date: _print(entry["parts"]) for date, entry in state.dates.items()},
        "spends": _landed(spark, landed),
    }
    version = uuid.uuid4().hex
    changed = {
        side: sorted(date for date, now in prints.items() if old[side].get(date, {}).get("of") != now)
        for side, prints in made_of.items()
    }
    present: dict[str, set[str]] = {}
    if changed["bookings"]:
        rows = versions.read(spark, staging, state.folders(changed["bookings"]), STAGING_SCHEMA)
        for kind, part in _booking_kinds(rows).items():
            present[kind] = _write(spark, root, kind, version, part, PARTITION)
    if changed["spends"]:
        paths = [f"{landed.rstrip('/')}/{SPEND_DATE}={files.escaped(spark, date)}" for date in changed["spends"]]
        rows = tables.read_spends(spark, paths, landed).withColumn(SPEND_DATE, F.col(SPEND_DATE).cast("string"))
        present[SPENDS] = _write(spark, root, SPENDS, version, channel_totals(rows, SPEND_DATE), SPEND_DATE)
    now = {side: {date: old[side][date] for date in prints if date in old[side]} for side, prints in made_of.items()}
    for side, dates in changed.items():
        for date in dates:
            kinds = sorted(kind for kind, having in present.items() if (kind == SPENDS) == (side == "spends") and date in having)
            now[side][date] = {"of": made_of[side][date], "version": version, "kinds": kinds}
    if now != old:
        files.replace_text(spark, f"{root}/{CURRENT}", json.dumps(now, sort_keys=True))
        _sweep(spark, root, old, now)
    return States(root, now["bookings"], now["spends"], changed["bookings"] + changed["spends"])


def _sweep(spark: SparkSession, root: str, *kept: dict) -> None:
    """Remove versions that neither this pointer nor the one before names: readers of that may still be there."""
    named = {entry["version"] for pointer in kept for side in pointer.values() for entry in side.values()}
    for kind in KINDS:
        for folder in files.child_folders(spark, f"{root}/{kind}"):
            if folder.rsplit("=", 1)[1] not in named:
                files.remove(spark, folder)


def curate(
    spark: SparkSession, states: States, channels: DataFrame, start: str | None = None, end: str | None = None
) -> Curated:
    """The curated tables from partial results, bookings of the folder dates from ``start`` to ``end``.

    Only what the eight marts use: bookings are events and meeting days, once each, and spends are sums.
    """
    dates = [d for d in states.bookings if (start is None or d >= start) and (end is None or d <= end)]
    days = states.read(spark, DAYS, dates)
    totals = states.read(spark, SPENDS).groupBy("channel").agg(
        F.sum("channel_spend").alias("channel_spend"), F.sum("spend_rows").alias("spend_rows")
    )
    return Curated(
        bookings=days,
        channel_map=channels,
        spends=None,
        memberships=states.read(spark, MEMBERS, dates),
        employees=curated.latest_names(states.read(spark, NAMES, dates)),
        hourly=states.read(spark, HOURS, dates),
        totals=totals,
    )
