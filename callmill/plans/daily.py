"""The daily job: raw documents of all pending dates to the staging table.

Three steps, each leaving a written table behind, so a lost executor costs tasks
and a lost driver costs at most the step it was in:

1. read every raw document once, write rows and refusals with their reasons;
2. dedup the new rows together with the stored rows of the same buckets of the same dates, written as
   folders that the table does not know yet;
3. publish the table's next state, which names them.

Dates are split into buckets by the hash of the event, more of them the larger a date is, and a merge reads and writes the
buckets alone that new rows fall into: one late document costs a bucket, not its day. Buckets that are too small for a folder of
their own share folders. What was published
stays as it was, and the table's readers see either state whole (see ``sources/versions.py``).

One run at a time: a lease in the work folder says which (see ``plans/lease.py``). Of the work folder's children
only those that a run has marked as its own are ever removed.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, replace
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.operators.dedup import latest_bookings
from callmill.operators.staging import refused_rows, stage_documents, staged_rows
from callmill.plans.lease import Busy, Lease
from callmill.schemas import PARTITION, QUARANTINE_SCHEMA, STAGING_SCHEMA
from callmill.sources import files, ledger, tables, versions
from callmill.sources.documents import FILES, Layout, pending_documents, raw_documents
from callmill.sources.versions import BUCKET, State

__all__ = ["Busy", "Stores", "ingest", "read_quarantine", "quarantine_reasons", "run_daily"]

REBUILD = "rebuild"
APPEND = "append"

# The run id of batch runs in rebuild mode, whose refusals are those of the raw folder as it is.
BATCH = "batch"

LOCK = "_lock"
MARK = "_callmill_run"
# What a run has written that no state names yet, and the state that it was ready to publish.
WRITTEN, READY = "_written.json", "_ready.json"

# Folder of refusals by the date of their batch; loose files have none.
FOLDER = "folder"
NO_DATE = "none"

# A date has a bucket for so many rows, and is split anew when it has grown to a multiple of that.
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 1024
REGROW = 4
# Small buckets share folders of so many rows, and a date is written whole when its folders hold a multiple of its buckets,
# most of which no longer count.
FOLDER_ROWS = 2_000_000
REPACK = 2


@dataclass(frozen=True)
class Stores:
    """Where a pipeline keeps its data. ``work`` must be shared by all executors.

    A catalog ``table`` has one folder for each date, so with one every merge writes its dates whole.
    """

    raw: str
    staging: str
    quarantine: str
    work: str
    table: str | None = None
    bucket_rows: int = BUCKET_ROWS

    def check(self, spark: SparkSession) -> None:
        """Refuse stores that lie in one another: one's files would be taken for the other's."""
        paths = {name: files.qualified(spark, getattr(self, name)) for name in ("raw", "staging", "quarantine", "work")}
        for (a, x), (b, y) in combinations(paths.items(), 2):
            if f"{x}/".startswith(f"{y}/") or f"{y}/".startswith(f"{x}/"):
                raise ValueError(f"{a} ({x}) and {b} ({y}) must not contain each other")


def run_daily(
    spark: SparkSession, stores: Stores, layout: Layout = FILES, mode: str = REBUILD, take_over: bool = False
) -> list[str]:
    """Process what is new in the raw folder; returns the dates that got rows.

    In ``rebuild`` mode the files taken are remembered with the rows they gave, by path, size and time of change, and are
    not read again. A file that went away takes its refusals with it, and one that changed is read anew; the rows of
    either stay. ``append`` mode takes the whole folder each time.
    """
    stores.check(spark)
    if mode == APPEND:
        documents = raw_documents(spark, stores.raw, layout)
        return ingest(spark, documents, stores, uuid.uuid4().hex, mode, take_over, remember=False)
    with _Writer(spark, stores, take_over) as lease:
        state = versions.current(spark, stores.staging)
        found = ledger.compare(spark, stores.staging, state.ledger, stores.raw, layout)
        documents = pending_documents(spark, stores.raw, layout, found.fresh)
        return _take(spark, documents, stores, BATCH, mode, lease, found)


def ingest(
    spark: SparkSession,
    documents: DataFrame,
    stores: Stores,
    run_id: str,
    mode: str = REBUILD,
    take_over: bool = False,
    remember: bool = True,
) -> list[str]:
    """Take documents (source_file, body, event_date) through to the table.

    The same ``run_id`` replaces the refusals it left for the same dates. In ``rebuild`` mode
    repeating a run changes nothing. ``append`` adds each run's rows as they are, deduplicated only among themselves, and
    publishes the run's id with them: a run id whose rows are in adds nothing again. ``remember=False`` is for ids that
    cannot come back. ``take_over`` ignores the lease of a run that is known to be dead.
    """
    stores.check(spark)
    with _Writer(spark, stores, take_over) as lease:
        if mode == APPEND and _is_in(versions.current(spark, stores.staging), run_id):
            return []
        return _take(spark, documents, stores, run_id, mode, lease, None, remember)


class _Writer(Lease):
    """The lease of a store, whose holder begins by tidying up after dead ones."""

    def __init__(self, spark: SparkSession, stores: Stores, take_over: bool):
        super().__init__(spark, f"{stores.work.rstrip('/')}/{LOCK}", versions.current(spark, stores.staging).token, take_over)
        self.stores = stores

    def __enter__(self) -> _Writer:
        super().__enter__()
        try:
            if self.taken_over:
                # From here on the run before cannot publish, should it still be there.
                state = versions.current(self.spark, self.stores.staging)
                versions.publish(self.spark, self.stores.staging, replace(state, token=self.token))
            _recover(self.spark, self.stores, self)
        except BaseException:
            self.__exit__()
            raise
        return self


def _take(
    spark: SparkSession,
    documents: DataFrame,
    stores: Stores,
    run_id: str,
    mode: str,
    lease: Lease,
    found: ledger.Found | None,
    remember: bool = True,
) -> list[str]:
    run = f"{stores.work.rstrip('/')}/run={run_id}"
    files.create_new(spark, f"{run}/{MARK}")
    stage_documents(documents).write.mode("overwrite").parquet(f"{run}/read")
    read = spark.read.parquet(f"{run}/read")
    lease.check()
    state = versions.current(spark, stores.staging)
    _quarantine(spark, read, run, stores, run_id, found)
    new = staged_rows(read)
    # One row per date folder.
    counts = {row[0]: row[1] for row in new.groupBy(PARTITION).count().collect()}
    fresh = replace(state, token=lease.token)
    if found is not None:
        fresh = replace(fresh, ledger=found.version)
    if mode == APPEND and remember:
        fresh = replace(fresh, batches=_with_batch(fresh.batches, run_id))
    if counts:
        fresh = _merged(spark, stores, fresh, new, counts, mode, run)
    if replace(fresh, token=state.token) != state:
        files.create_new(spark, f"{run}/{READY}", json.dumps({"state": asdict(fresh), "dates": sorted(counts)}))
        _publish(spark, stores, fresh, lease, sorted(counts))
    files.remove(spark, run)
    return sorted(counts)


def _stream(run_id: str) -> tuple[str, int | None]:
    """A stream's batches are numbered; any other id stands for itself."""
    name, _, number = run_id.rpartition("-")
    return (name, int(number)) if name and number.isdigit() else (run_id, None)


def _is_in(state: State, run_id: str) -> bool:
    name, number = _stream(run_id)
    return name in state.batches and (number is None or number <= state.batches[name])


def _with_batch(batches: dict[str, int], run_id: str) -> dict[str, int]:
    name, number = _stream(run_id)
    return {**batches, name: number or 0}


def _of_date(rows: DataFrame, numbers: dict[str, int], name: str) -> DataFrame:
    """``rows`` with the number of their date."""
    # One row per date folder, in the plan itself: so Spark knows its size and need not shuffle the rows to meet it.
    listed = ", ".join(f"({files.quoted(date)}, {n})" for date, n in sorted(numbers.items()))
    return rows.join(rows.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t({PARTITION}, {name})"), PARTITION)


def _bucketed(rows: DataFrame, spread: dict[str, int]) -> DataFrame:
    """``rows`` with their bucket, by the number of buckets of their date."""
    if set(spread.values()) <= {1}:
        return rows.withColumn(BUCKET, F.lit(0))
    bucket = F.pmod(F.xxhash64("event"), F.col("_buckets")).cast("int")
    return _of_date(rows, spread, "_buckets").select(*rows.columns, bucket.alias(BUCKET))


def _folders(state: State, added: dict[str, int], spread: dict[str, int]) -> dict[str, int]:
    """Folders of each date: one for each of its buckets, or fewer where those are small."""
    rows = {date: n + (state.dates[date]["rows"] if date in state.dates else 0) for date, n in added.items()}
    return {date: min(spread[date], max(1, math.ceil(n / FOLDER_ROWS))) for date, n in rows.items()}


def _write(rows: DataFrame, root: str, version: str, spread: dict[str, int], folders: dict[str, int]) -> None:
    if folders == spread:
        tables.write_version(rows, root, version)
        return
    # Adjacent buckets lie together.
    shared = _of_date(_of_date(rows, spread, "_buckets"), folders, "_folders")
    numbered = shared.withColumn("_folder", F.expr(f"CAST({BUCKET} * _folders DIV _buckets AS INT)"))
    tables.write_version(numbered.select(*rows.columns, "_folder"), root, version, F.col("_folder"))


def _spread(stores: Stores, state: State, added: dict[str, int], merge: bool) -> tuple[dict[str, int], set[str]]:
    """Buckets of each date, and the dates that are written whole: those that are new, have outgrown their buckets, hold too
    much in shared folders that no longer counts, or belong to a catalog table."""
    spread, whole = {}, set()
    for date, n in added.items():
        stored = state.dates.get(date)
        rows = n + (stored["rows"] if stored else 0)
        wanted = 1 if stores.table else max(1, min(MOST_BUCKETS, math.ceil(rows / stores.bucket_rows)))
        packed = sum(part.get("packed", 0) for part in stored["parts"].values()) if stored else 0
        fits = stored and wanted < REGROW * stored["buckets"] and packed <= REPACK * stored["buckets"]
        if stored and not stores.table and (not merge or fits):
            spread[date] = stored["buckets"]
        else:
            spread[date] = wanted
            whole.add(date)
    return spread, whole


def _merged(
    spark: SparkSession, stores: Stores, state: State, new: DataFrame, added: dict[str, int], mode: str, run: str
) -> State:
    """Write the new rows, merged with the stored ones they meet, and return the state that names them."""
    version = uuid.uuid4().hex
    merge = mode != APPEND or stores.table is not None
    spread, whole = _spread(stores, state, added, merge)
    in_buckets = set(added) - whole
    new = _bucketed(new, spread)
    met: dict[str, set[int]] = {date: set() for date in in_buckets}
    if merge and in_buckets:
        # A row for each bucket of these dates.
        for date, bucket in new.where(F.col(PARTITION).isin(sorted(in_buckets))).select(PARTITION, BUCKET).distinct().collect():
            met[date].add(bucket)
    stored = state.folders(whole) | state.folders(in_buckets, met) if merge else set()
    old = _bucketed(versions.read(spark, stores.staging, stored, STAGING_SCHEMA).select(*STAGING_SCHEMA.names), spread)
    old = old.select(*new.columns)
    rows = old.unionByName(latest_bookings(new)) if mode == APPEND else latest_bookings(old.unionByName(new))
    # Should this run die, the next one knows what it may have left.
    files.create_new(spark, f"{run}/{WRITTEN}", json.dumps({"version": version, "dates": sorted(added)}))
    folders = _folders(state, added, spread)
    _write(rows, stores.staging, version, spread, folders)
    written = versions.counted(spark, stores.staging, version, sorted(added))
    dates = dict(state.dates)
    for date, n in added.items():
        before = dates.get(date, {"rows": 0, "parts": {}})
        parts = before["parts"]
        if merge:
            parts = {} if date in whole else versions.without(parts, met[date])
        part = {"buckets": sorted(written[date]), "whole": True}
        if folders[date] < spread[date]:
            part["packed"] = len(part["buckets"])
        parts = {**parts, version: part}
        # How many rows a merge dropped is only known where all were written: else a bound.
        rows_now = sum(written[date].values()) if len(parts) == 1 else before["rows"] + n
        dates[date] = {"buckets": spread[date], "rows": rows_now, "parts": parts}
    return replace(state, dates=dates)


def _publish(spark: SparkSession, stores: Stores, state: State, lease: Lease, dates: list[str]) -> State:
    """The step that shows: before it nothing of a run does, after it everything."""
    lease.check()
    state = versions.publish(spark, stores.staging, state)
    _register(spark, stores, state, dates)
    versions.sweep(spark, stores.staging)
    return state


def _recover(spark: SparkSession, stores: Stores, lease: Lease) -> None:
    """Publish what a dead run had ready, if nothing was published since; drop what it had not. Folders of others are left
    alone."""
    for run in files.child_folders(spark, stores.work):
        if not run.rsplit("/", 1)[1].startswith("run=") or not files.exists(spark, f"{run}/{MARK}"):
            continue
        ready, written = (json.loads(files.read_text(spark, f"{run}/{name}") or "null") for name in (READY, WRITTEN))
        now = versions.current(spark, stores.staging)
        if ready:
            state = State(**ready["state"])
            if versions.unchanged_since(spark, stores.staging, state.number, now):
                now = _publish(spark, stores, replace(state, number=now.number, token=lease.token), lease, ready["dates"])
        for date in written["dates"] if written else []:
            if written["version"] not in now.dates.get(date, {"parts": {}})["parts"]:
                files.remove(spark, versions.folder(spark, stores.staging, date, written["version"]))
        files.remove(spark, run)


def _quarantine(
    spark: SparkSession, read: DataFrame, run: str, stores: Stores, run_id: str, found: ledger.Found | None
) -> None:
    """Replace this run id's refusals of every date that was read, also where none are left.

    Where files are taken once, refusals of the same dates stay whose files are still there as they were.
    """
    folder = F.when(F.col(PARTITION) == "", NO_DATE).otherwise(F.col(PARTITION)).alias(FOLDER)
    place = f"{stores.quarantine.rstrip('/')}/run_id={run_id}"
    refused = refused_rows(read).select("*", folder)
    # One value per date folder, small on any input.
    seen = {row[0] for row in read.select(folder).distinct().collect()}
    if found is not None:
        seen |= {date or NO_DATE for date in found.gone_dates}
        kept = [path for path in files.child_folders(spark, place) if unquote_folder(path) in seen]
        if kept:
            before = spark.read.schema(QUARANTINE_SCHEMA).parquet(*kept).select(*QUARANTINE_SCHEMA.names)
            unchanged = before.join(found.unchanged, "source_file", "left_semi")
            refused = refused.unionByName(unchanged.select(*QUARANTINE_SCHEMA.names, folder))
    refused.write.mode("overwrite").partitionBy(FOLDER).parquet(f"{run}/refused")
    fresh = {path.rsplit("/", 1)[1]: path for path in files.child_folders(spark, f"{run}/refused")}
    for old in files.child_folders(spark, place):
        if unquote_folder(old) in seen:
            files.remove(spark, old)
    for name, path in fresh.items():
        files.move(spark, path, f"{place}/{name}")


def unquote_folder(path: str) -> str:
    return tables.unquote(path.rsplit("/", 1)[1].split("=", 1)[1])


def read_quarantine(spark: SparkSession, stores: Stores) -> DataFrame:
    """All refusals; empty if nothing was ever refused."""
    if not files.child_folders(spark, stores.quarantine):
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(stores.quarantine).select(*QUARANTINE_SCHEMA.names)


def _register(spark: SparkSession, stores: Stores, state: State, dates: list[str]) -> None:
    if stores.table and dates:
        tables.declare_table(spark, stores.table, stores.staging)
        tables.register_dates(spark, stores.table, stores.staging, state, dates)
        spark.catalog.refreshTable(stores.table)


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))
