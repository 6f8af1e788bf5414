"""Date-partitioned tables: write, read back, register."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.schemas import PARTITION, SPEND_SCHEMA, STAGING_SCHEMA
from callmill.sources import versions
from callmill.sources.files import quoted


def write_version(rows: DataFrame, root: str, version: str, folder: Column | None = None) -> None:
    """Rows (with a bucket) as new folders of a versioned table, sized as they will be read. Nothing refers to them yet.

    ``folder`` is the number of the folder that a bucket shares with others, if some do.
    """
    folders = [PARTITION, versions.VERSION, versions.BUCKET]
    dealt = rows.withColumn(versions.VERSION, F.lit(version))
    if folder is not None:
        dealt = dealt.withColumns({versions.ROW_BUCKET: F.col(versions.BUCKET), versions.BUCKET: folder})
    # Groups each folder's rows into few files, and splits one too large for one task.
    dealt = dealt.hint("rebalance", PARTITION, versions.BUCKET)
    if folder is not None:
        dealt = dealt.sortWithinPartitions(*folders, versions.ROW_BUCKET)
    dealt.write.mode("append").partitionBy(*folders).parquet(root)


def read_staging(
    spark: SparkSession, path: str, schema: T.StructType = STAGING_SCHEMA, state: versions.State | None = None
) -> DataFrame:
    """The last state of the table at ``path``, or the one given; empty if nothing was published yet."""
    state = versions.current(spark, path) if state is None else state
    return versions.read(spark, path, state.folders(), schema)


def read_spends(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """Landed spends, all of them or, below ``root``, of some date folders."""
    reader = spark.read.schema(SPEND_SCHEMA)
    return (reader.option("basePath", root) if root else reader).json(path)


def declare_table(spark: SparkSession, name: str, path: str, schema: T.StructType = STAGING_SCHEMA) -> None:
    """An external table over ``path``; it sees the partitions that are registered."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({PARTITION}) LOCATION {quoted(path)}"
    )


def register_dates(spark: SparkSession, name: str, path: str, state: versions.State, dates: Iterable[str]) -> None:
    """Let the partitions of these dates point to their folders in ``state``.

    A partition has one folder, so every date must lie in one. Dates that are new are added in one statement, and each of
    the others is switched in one.
    """
    known = {unquote(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added = []
    for date in sorted(dates):
        place = f"LOCATION {quoted(versions.only_folder(spark, path, state, date))}"
        spec = f"PARTITION ({PARTITION} = {quoted(date)})"
        if date in known:
            spark.sql(f"ALTER TABLE {name} {spec} SET {place}")
        else:
            added.append(f"{spec} {place}")
    if added:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added)}")


def register_all(spark: SparkSession, name: str) -> None:
    """Register every date of the last state of the table's folder."""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").collect()
    path = rows[0].data_type
    state = versions.current(spark, path)
    register_dates(spark, name, path, state, state.dates)
