"""The daily spend load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from callmill.sources import files, snapshots


@dataclass(frozen=True)
class SpendLoad:
    file: str
    file_date: str
    records: int


def load_latest_spend(spark: SparkSession, snapshot_root: str, index_path: str, landed_root: str) -> SpendLoad:
    """Land the latest snapshot's own date; a second run replaces it with the same.

    A file that is no array of objects, or has a spend that is no number, raises and leaves the landed
    folder as it was.
    """
    listed = snapshots.index_files(spark, index_path)
    file, date = snapshots.require_latest(listed)
    read = snapshots.read_snapshots(spark, f"{snapshot_root.rstrip('/')}/{file}").withColumn("file", F.lit(file))
    snapshots.require_sound(snapshots.guards(listed.where(F.col("file") == file), read))
    count = snapshots.land_records(snapshots.of_date(read, F.lit(date)), date, landed_root)
    return SpendLoad(file, date, count)


def load_missing_spends(
    spark: SparkSession, snapshot_root: str, index_path: str, landed_root: str, everything: bool = False
) -> list[SpendLoad]:
    """Land every date that has not landed yet, each from the latest file that shows it; returns what was landed, by date.

    Files named for a day after the last landed one are read; ``everything`` reads all of them, and so finds a day that was
    left out between two others. A broken file among those raises and leaves the landed folder as it was. Nothing missing is no
    error: a second run lands nothing.
    """
    # One value per date folder and per listed file.
    landed = {path.rsplit("=", 1)[1] for path in files.child_folders(spark, landed_root) if "file_date=" in path}
    dated = snapshots.index_files(spark, index_path).distinct().withColumn("day", files.file_date(F.col("file")))
    dated = dated.where(F.col("day") != "")
    if landed and not everything:
        dated = dated.where(F.col("day") > max(landed))
    names = [row.file for row in dated.select("file").collect()]
    if not names:
        return []
    paths = [files.literal(f"{snapshot_root.rstrip('/')}/{name}") for name in names]
    read = snapshots.read_snapshots(spark, paths, named=True)
    snapshots.require_all_sound(snapshots.guards(dated, read))
    missing = snapshots.latest_of_dates(read).where(~F.col("date").isin(sorted(landed)) if landed else F.lit(True))
    loads = [
        SpendLoad(row.file, row.date, row.records)
        for row in missing.groupBy("file", "date").agg(F.count(F.lit(1)).alias("records")).orderBy("date").collect()
    ]
    if loads:
        snapshots.land_dates(missing, landed_root)
    return loads
