"""The right to write a store, kept alive by a heartbeat and checked before anything is published.

Leases are numbered files in one folder, the largest number counts. Taking over from a holder that is gone means to create
the next number, which one of several contenders can. The holder writes its file anew from a thread of its own, so
a long step does not look like a dead driver; all ages are differences of the file system's own times. A holder that another has
taken over from finds that out at its next check, and a publish after that fails by the table's manifest
numbers, as the new holder moves these on before it does anything else.
"""

from __future__ import annotations

import threading
import uuid
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from callmill.sources import files

DIGITS = 12
# A lease that no heartbeat has renewed for so long belongs to a driver that is gone.
LEASE = timedelta(minutes=15)
BEAT = timedelta(minutes=1)


class Busy(RuntimeError):
    """Another run holds the store, or has taken it over."""


def _now(spark: SparkSession, folder: str) -> datetime:
    """The file system's time."""
    probe = f"{folder}/probe-{uuid.uuid4().hex}"
    files.create_new(spark, probe)
    try:
        return files.modified(spark, probe)
    finally:
        files.remove(spark, probe)


def tokens(spark: SparkSession, folder: str) -> list[int]:
    names = [path.rsplit("/", 1)[1] for path in files.child_files(spark, folder)]
    return sorted(int(name) for name in names if name.isdigit() and len(name) == DIGITS)


class Lease:
    """``with Lease(…) as held``: ``held.check()`` raises if it is lost; ``held.taken_over`` says whether another had it."""

    def __init__(self, spark: SparkSession, folder: str, least: int = 0, take_over: bool = False):
        """``least``: the largest token that the store has seen. ``take_over`` ignores a holder known to be dead."""
        self.spark, self.folder = spark, folder.rstrip("/")
        self.least, self.take_over = least, take_over
        self.token, self.taken_over = 0, False
        self._ended = threading.Event()
        self._thread: threading.Thread | None = None

    def _path(self, token: int) -> str:
        return f"{self.folder}/{token:0{DIGITS}}"

    def __enter__(self) -> Lease:
        held = tokens(self.spark, self.folder)
        if held:
            beat = files.modified(self.spark, self._path(held[-1]))
            alive = beat is not None and _now(self.spark, self.folder) - beat <= LEASE
            if alive and not self.take_over:
                raise Busy(f"{self._path(held[-1])} is held by a run whose last heartbeat was at {beat}")
            self.taken_over = True
        self.token = max([self.least, *held]) + 1
        if not files.create_new(self.spark, self._path(self.token), "held"):
            raise Busy(f"{self._path(self.token)} was taken by another run")
        try:
            self.check()
        except Busy:
            files.remove(self.spark, self._path(self.token))
            raise
        for token in held:
            files.remove(self.spark, self._path(token))
        self._thread = threading.Thread(target=self._beat, daemon=True)
        self._thread.start()
        return self

    def _beat(self) -> None:
        while not self._ended.wait(BEAT.total_seconds()):
            try:
                if files.modified(self.spark, self._path(self.token)) is None:
                    return  # taken over
                files.replace_text(self.spark, self._path(self.token), "held")
            except Exception:  # noqa: BLE001 - a failed beat is tried again; a lease that runs out is found by check()
                continue

    def check(self) -> None:
        held = tokens(self.spark, self.folder)
        if self.token not in held or held[-1] != self.token:
            raise Busy(f"{self._path(self.token)} was taken over by another run")

    def __exit__(self, *_) -> None:
        self._ended.set()
        if self._thread:
            self._thread.join()
        files.remove(self.spark, self._path(self.token))
        files.remove_if_empty(self.spark, self.folder)
