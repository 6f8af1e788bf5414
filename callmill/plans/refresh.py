"""Mart snapshots: recomputed when older than a day, of another scope, or when forced.

A snapshot is a folder of its own. A small file per mart names the current one and
is replaced in one step when the new folder is complete, so a reader finds either
the old snapshot or the new one, and a crash leaves the old.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.operators.fanout import channel_totals
from callmill.plans.marts import MARTS, Curated, bookings_per_hour
from callmill.sources import files

# Fixed value: how long a result stays fresh.
FRESH_FOR = timedelta(seconds=86_400)

REFRESHED_AT = "refreshed_at"
RANK = "_rank"
CURRENT = "_current.json"
VERSION = "version="
HOURLY = "bookings_per_hour"
TOTALS = "channel_totals"


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def current(spark: SparkSession, root: str, name: str) -> dict | None:
    """What the mart's pointer says: version, time of completion and scope."""
    text = files.read_text(spark, f"{mart_path(root, name)}/{CURRENT}")
    return json.loads(text) if text else None


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current snapshot in the mart's order."""
    found = current(spark, root, name)
    if found is None:
        raise FileNotFoundError(f"{mart_path(root, name)} has no snapshot")
    rows = spark.read.parquet(f"{mart_path(root, name)}/{VERSION}{found['version']}")
    return rows.orderBy(RANK).drop(RANK, REFRESHED_AT)


def refreshed_at(spark: SparkSession, root: str, name: str) -> datetime | None:
    """When the current snapshot was completed; None if there is none."""
    found = current(spark, root, name)
    return datetime.fromisoformat(found["taken"]) if found else None


def refresh(
    spark: SparkSession,
    curated: Curated,
    root: str,
    force: bool = False,
    now: datetime | None = None,
    marts: Mapping[str, Callable[[Curated], DataFrame]] = MARTS,
    scope: str = "",
) -> list[str]:
    """Renew every mart that is stale; returns their names.

    ``scope`` says what ``curated`` was made from, dates and inputs: a snapshot of another scope
    is stale whatever its age. The bookings are counted per hour first, in one scan, and the spends
    per channel, unless ``curated`` brings these along, and the marts are built on these; only the employee mart reads
    the bookings again. The
    order is kept by a rank column, so the final sort may be spread over tasks.
    """
    now = now or datetime.now(timezone.utc)
    stale = [name for name in marts if force or _is_stale(current(spark, root, name), now, scope)]
    version = uuid.uuid4().hex
    shared = f"{mart_path(root, '_shared')}/{VERSION}{version}"
    if stale and curated.hourly is None:
        bookings_per_hour(curated).write.parquet(f"{shared}/{HOURLY}")
        curated = replace(curated, hourly=spark.read.parquet(f"{shared}/{HOURLY}"))
        if curated.spends is not None and curated.totals is None:
            channel_totals(curated.spends).write.parquet(f"{shared}/{TOTALS}")
            curated = replace(curated, totals=spark.read.parquet(f"{shared}/{TOTALS}"))

    def write(name: str) -> None:
        ranked = marts[name](curated).withColumns({RANK: F.monotonically_increasing_id(), REFRESHED_AT: F.lit(now)})
        ranked.write.parquet(f"{mart_path(root, name)}/{VERSION}{version}")
        _switch(spark, root, name, version, scope)

    # Small jobs for the most part; side by side they fill the gaps of the large one.
    with ThreadPoolExecutor() as pool:
        list(pool.map(write, stale))
    if stale:
        files.remove(spark, shared)
    return stale


def _switch(spark: SparkSession, root: str, name: str, version: str, scope: str) -> None:
    """Point to the new snapshot; the one before stays for its readers, older ones go."""
    before = current(spark, root, name)
    kept = {version, before["version"]} if before else {version}
    pointer = {"version": version, "taken": datetime.now(timezone.utc).isoformat(), "scope": scope}
    files.replace_text(spark, f"{mart_path(root, name)}/{CURRENT}", json.dumps(pointer))
    for folder in files.child_folders(spark, mart_path(root, name)):
        label = folder.rsplit("/", 1)[1]
        if label.startswith(VERSION) and label.removeprefix(VERSION) not in kept:
            files.remove(spark, folder)


def _is_stale(found: dict | None, now: datetime, scope: str) -> bool:
    return found is None or found["scope"] != scope or now - datetime.fromisoformat(found["taken"]) >= FRESH_FOR
