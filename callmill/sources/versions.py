"""A date table whose readers see one state after another, each whole.

Rows lie in ``event_date=…/version=…/bucket=…`` folders that are written once and never changed. A manifest, a small
numbered file, says which of them make up the table; the one with the largest number is the table. A run writes folders that
no manifest names, and then the next manifest: readers find the old state before that and the new one after it, and a
run that dies leaves the old. A number is taken by one writer only, so a writer that started from a state that is no longer
the last cannot publish, whatever it believes to hold.

The parts of a date are keyed by version: which buckets of it count, and whether that is all that was written. Rows
appended without a merge may lie in buckets that other versions have too.

A folder for each of many small buckets would take far longer to make, to list and to open than its rows, so such buckets share
folders: a part that says how many buckets were ``packed`` in it has their numbers in its rows, sorted by them. Those of its buckets that no longer
count are filtered out on reading, and go when none of the part counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.schemas import PARTITION
from callmill.sources import files
from callmill.sources.files import quoted

MANIFESTS = "_manifest"
LEDGERS = "_ledger"
VERSION = "version"
BUCKET = "bucket"
# A row's bucket in a folder that several share; not there in one of a bucket's own.
ROW_BUCKET = "_bucket"
DIGITS = 12
# The state before the last stays for its readers.
KEPT = 2


class Outdated(RuntimeError):
    """Another writer has published since this one read the table's state."""


@dataclass(frozen=True)
class State:
    """One state of a table.

    dates: for each date its number of buckets, an upper bound of its rows, and its parts {version: {buckets, whole}}, with
    packed where buckets share folders.
    batches: the batches whose rows are in, by stream the last one. ledger: the version of the files that were taken.
    """

    number: int = 0
    token: int = 0
    dates: dict[str, dict] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    ledger: str | None = None

    def folders(self, dates: Iterable[str] | None = None, buckets: dict[str, set[int]] | None = None) -> set[tuple]:
        """(date, version, bucket) of the table's folders, bucket None for all of a version's, and all that count as a tuple where they
        share folders with others; of some dates, or of some buckets of them."""
        found = set()
        for date in self.dates if dates is None else dates:
            for version, part in self.dates.get(date, {"parts": {}})["parts"].items():
                wanted = None if buckets is None else buckets[date]
                some = [b for b in part["buckets"] if wanted is None or b in wanted]
                if part["whole"] and len(some) == len(part["buckets"]):
                    found.add((date, version, None))
                elif "packed" not in part:
                    found.update((date, version, b) for b in some)
                elif some:
                    found.add((date, version, tuple(some)))
        return found


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:0{DIGITS}}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    names = files.child_files(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    stems = [name.rsplit("/", 1)[1].removesuffix(".json") for name in names]
    return sorted(int(stem) for stem in stems if stem.isdigit() and len(stem) == DIGITS)


def state_of(spark: SparkSession, root: str, number: int) -> State:
    text = files.read_text(spark, _manifest(root, number))
    if text is None:
        raise Outdated(f"state {number} of {root} is gone")
    return State(**json.loads(text))


def current(spark: SparkSession, root: str) -> State:
    """The last state; an empty one if there is none yet."""
    found = numbers(spark, root)
    return state_of(spark, root, found[-1]) if found else State()


def publish(spark: SparkSession, root: str, state: State) -> State:
    """Make ``state`` the next one after the number it was read with; returns it with its new number."""
    fresh = replace(state, number=state.number + 1)
    if not files.put_new(spark, _manifest(root, fresh.number), json.dumps(asdict(fresh), sort_keys=True)):
        raise Outdated(f"{root} has a state {fresh.number} already")
    return fresh


def folder(spark: SparkSession, root: str, date: str, version: str, bucket: int | None = None) -> str:
    place = f"{root.rstrip('/')}/{PARTITION}={files.escaped(spark, date)}/{VERSION}={version}"
    return place if bucket is None else f"{place}/{BUCKET}={bucket}"


def read(spark: SparkSession, root: str, folders: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """The rows of these folders with the columns of ``schema``."""
    places = sorted(folders, key=repr)
    if not places:
        return spark.createDataFrame([], schema)
    shared = [where for where in places if isinstance(where[2], tuple)]
    found = []
    if paths := [folder(spark, root, *where) for where in places if not isinstance(where[2], tuple)]:
        found.append(spark.read.option("basePath", root).schema(schema).parquet(*paths).select(*schema.names))
    if shared:
        given = [field for field in schema if field.name != PARTITION]
        texts = [T.StructField(name, T.StringType()) for name in (PARTITION, VERSION)]
        numbered = T.StructType([*given, *texts, T.StructField(ROW_BUCKET, T.IntegerType())])
        rows = spark.read.option("basePath", root).schema(numbered).parquet(*[folder(spark, root, *where[:2]) for where in shared])
        # Sorted by bucket, a file is read only where these are.
        wanted = [f"({PARTITION} = {quoted(d)} AND {VERSION} = {quoted(v)} AND {ROW_BUCKET} IN ({', '.join(map(str, some))}))" for d, v, some in shared]
        found.append(rows.where(" OR ".join(wanted)).select(*schema.names))
    return reduce(DataFrame.unionByName, found)


def only_folder(spark: SparkSession, root: str, state: State, date: str) -> str:
    """The one folder of a date that was written as a whole and in one bucket."""
    parts = state.dates[date]["parts"]
    places = [(version, b) for version, part in parts.items() for b in part["buckets"]]
    if len(places) != 1 or any("packed" in part for part in parts.values()):
        raise ValueError(f"{date} of {root} lies in {len(places)} folders")
    return folder(spark, root, date, *places[0])


def counted(spark: SparkSession, root: str, version: str, dates: Iterable[str]) -> dict[str, dict[int, int]]:
    """Rows by date and bucket of a version that was written for all of these dates. Only the numbers of buckets are read."""
    paths = [folder(spark, root, date, version) for date in dates]
    rows = spark.read.option("basePath", root).schema(f"{PARTITION} string, {BUCKET} int, {ROW_BUCKET} int").parquet(*paths)
    found: dict[str, dict[int, int]] = {}
    for date, bucket, n in rows.groupBy(PARTITION, F.coalesce(ROW_BUCKET, BUCKET)).count().collect():
        found.setdefault(date, {})[bucket] = n
    return found


def unchanged_since(spark: SparkSession, root: str, number: int, now: State) -> bool:
    """Whether the table's rows are those of an earlier state: a new holder's first state moves only the number on."""
    try:
        before = state_of(spark, root, number) if number else State()
    except Outdated:
        return False
    return (before.dates, before.batches, before.ledger) == (now.dates, now.batches, now.ledger)


def sweep(spark: SparkSession, root: str) -> None:
    """Remove manifests older than the last KEPT, and the folders that only they name.

    A run that dies in it leaves manifests that the next sweep starts with again.
    """
    found = numbers(spark, root)
    kept = [state_of(spark, root, n) for n in found[-KEPT:]]
    named = {(date, version, b) for state in kept for date, d in state.dates.items() for version, p in d["parts"].items() for b in p["buckets"]}
    alive = {where[:2] for where in named}
    for number in found[:-KEPT]:
        for date, entry in state_of(spark, root, number).dates.items():
            for version, part in entry["parts"].items():
                if (date, version) not in alive:
                    files.remove(spark, folder(spark, root, date, version))
                    continue
                for b in [] if "packed" in part else part["buckets"]:
                    if (date, version, b) not in named:
                        files.remove(spark, folder(spark, root, date, version, b))
        files.remove(spark, _manifest(root, number))
    # Lists of runs that died before they could publish are named by no state at all.
    lists = {ledger_folder("", state.ledger).rsplit("/", 1)[1] for state in kept if state.ledger is not None}
    for path in files.child_folders(spark, f"{root.rstrip('/')}/{LEDGERS}"):
        if path.rsplit("/", 1)[1] not in lists:
            files.remove(spark, path)


def ledger_folder(root: str, version: str) -> str:
    """Where the list of taken files is that a state names."""
    return f"{root.rstrip('/')}/{LEDGERS}/{VERSION}={version}"


def without(parts: dict[str, dict], buckets: set[int]) -> dict[str, dict]:
    """A date's parts less these buckets."""
    left = {}
    for version, part in parts.items():
        rest = [b for b in part["buckets"] if b not in buckets]
        if rest:
            left[version] = {**part, "buckets": rest, "whole": part["whole"] and len(rest) == len(part["buckets"])}
    return left
