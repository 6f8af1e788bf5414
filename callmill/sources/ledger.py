"""Which raw files a table's rows came from: the list of files taken, and what has come, gone or changed since."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.schemas import PARTITION
from callmill.sources import files, versions
from callmill.sources.documents import Layout

# `path` is how Spark opens a file, `source_file` how it names one in a row.
SCHEMA = f"path string, source_file string, length bigint, modified timestamp, {PARTITION} string"
SAME = ["source_file", "length", "modified"]


@dataclass(frozen=True)
class Found:
    """What a comparison found: the version of the new list, the paths of files to read (None for all there are), the files
    that were taken before and are as they were, and the dates of files that are not."""

    version: str | None
    fresh: list[str] | None
    unchanged: DataFrame
    gone_dates: set[str]


def listing(spark: SparkSession, root: str, layout: Layout) -> DataFrame:
    """The files of the raw folder. No content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{layout.suffix}").option("recursiveFileLookup", "true")
    return reader.load(root).select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        "length",
        F.col("modificationTime").alias("modified"),
        files.batch_folder(spark, root).alias(PARTITION),
    )


def taken(spark: SparkSession, root: str, version: str | None) -> DataFrame:
    """The list that a state names; empty if it names none."""
    if version is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(versions.ledger_folder(root, version))


def compare(spark: SparkSession, table: str, version: str | None, raw: str, layout: Layout) -> Found:
    """Write the list of the files that are there now and set it against the one that the table's state names.

    The paths of new files come to the driver, which lists the files of every scan anyway.
    """
    fresh = uuid.uuid4().hex
    listing(spark, raw, layout).write.parquet(versions.ledger_folder(table, fresh))
    now, before = taken(spark, table, fresh), taken(spark, table, version)
    if version is None:
        return Found(fresh, None, before, set())
    new = [row.path for row in now.join(before, SAME, "left_anti").select("path").collect()]
    # One value per date folder.
    gone = {row[0] for row in before.join(now, SAME, "left_anti").select(PARTITION).distinct().collect()}
    if not new and not gone:
        files.remove(spark, versions.ledger_folder(table, fresh))
        return Found(version, [], before, set())
    return Found(fresh, new, now.join(before, SAME, "left_semi"), gone)
