"""Daily spend snapshots: index, latest file, records of its own date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callmill.functions import json_kinds as K
from callmill.sources.files import DATE_IN_NAME, file_date

INDEX_SCHEMA = "files array<string>"


class EmptySnapshot(ValueError):
    """Nothing to load: no file, no date in its name, or no record of that date."""


class BrokenSnapshot(ValueError):
    """A file that is not one JSON array of objects, or a spend that is no number."""


def index_files(spark: SparkSession, index_path: str) -> DataFrame:
    """File names listed in ``{"files": [...]}``."""
    index = spark.read.schema(INDEX_SCHEMA).json(index_path, multiLine=True)
    return index.select(F.explode("files").alias("file"))


def latest_file(files: DataFrame) -> DataFrame:
    """The largest name (names sort by date) and its date; one row."""
    return files.agg(F.max("file").alias("file")).select("file", file_date(F.col("file")).alias("file_date"))


def require_latest(files: DataFrame) -> tuple[str, str]:
    file, date = latest_file(files).first()
    if file is None:
        raise EmptySnapshot("the index lists no files")
    if not date:
        raise EmptySnapshot(f"no date in the file name {file!r}")
    return file, date


def _fault(element: Column) -> Column:
    spend = K.child(element, "$.spend")
    number = K.kind(spend).isin(K.MISSING, K.NULL, K.INTEGER, "DECIMAL", "DOUBLE", "FLOAT")
    return F.when(~K.is_object(element), "record_not_object").when(~number, "spend_not_number")


def read_snapshots(spark: SparkSession, path: str | list[str], named: bool = False) -> DataFrame:
    """Every element of every file, with ``fault`` where something is wrong; columns found by folder stay. ``named`` adds the
    file's name as ``file``.

    A file is read as one text and must be one JSON array and nothing else; one that is not gives a single row with the
    fault ``file_not_array``. ``line`` is the element's JSON with every field kept.
    """
    text = F.col("value")
    array = K.elements(F.try_parse_json(text))
    sound = F.coalesce(F.is_valid_utf8(text) & K.ends_cleanly(text), F.lit(False)) & array.isNotNull()
    texts = spark.read.text(path, wholetext=True)
    if named:
        texts = texts.select("*", F.col("_metadata.file_name").alias("file"))
    kept = [name for name in texts.columns if name != "value"]
    files = texts.withColumn("elements", F.when(sound, array))
    nothing = F.array(F.lit(None).cast("variant"))
    elements = files.select(
        *kept,
        F.col("elements").isNull().alias("broken"),
        F.explode(F.coalesce("elements", nothing)).alias("element"),
    )
    element = F.col("element")
    return elements.select(
        *kept,
        F.when(F.col("broken"), "file_not_array").otherwise(_fault(element)).alias("fault"),
        F.try_variant_get(element, "$.date", "string").alias("date"),
        F.try_variant_get(element, "$.channel", "string").alias("channel"),
        F.try_variant_get(element, "$.spend", "double").alias("spend"),
        F.to_json(element).alias("line"),
    )


def guards(files: DataFrame, read: DataFrame) -> DataFrame:
    """For each listed file its date (''), faults, and records of its own date: what decides whether it loads."""
    date = file_date(F.col("file"))
    found = read.groupBy("file").agg(
        F.min("fault").alias("fault"),
        F.count_if(F.col("fault").isNull() & (F.col("date") == date)).alias("records"),
    )
    return files.select("file").distinct().join(found, "file", "left").select(
        "file", date.alias("file_date"), "fault", F.coalesce("records", F.lit(0)).cast("bigint").alias("records")
    )


def require_sound(guarded: DataFrame) -> None:
    """Raise for a guarded file that must not be loaded."""
    row = guarded.first()
    if row.fault:
        raise BrokenSnapshot(f"{row.file}: {row.fault}")
    if not row.records:
        raise EmptySnapshot(f"no records of {row.file_date}")


def require_all_sound(guarded: DataFrame) -> None:
    """Raise if any guarded file has a fault."""
    row = guarded.where(F.col("fault").isNotNull()).orderBy("file").first()
    if row:
        raise BrokenSnapshot(f"{row.file}: {row.fault}")


def latest_of_dates(read: DataFrame) -> DataFrame:
    """For every date, the records of the latest file that shows it."""
    dated = read.where(F.col("fault").isNull() & F.col("date").rlike(f"^{DATE_IN_NAME}$"))
    # As many rows as dates are shown.
    shown = dated.groupBy("date").agg(F.max("file").alias("file"))
    return dated.join(shown, ["date", "file"])


def of_date(records: DataFrame, date: Column) -> DataFrame:
    """Records whose ``date`` equals the file's as text; a missing date drops."""
    return records.where(F.col("date") == date)


def land_dates(records: DataFrame, root: str) -> None:
    """Replace the folder of every date that has records here."""
    rows = records.select(F.col("line").alias("value"), F.col("date").alias("file_date"))
    (
        rows.hint("rebalance", "file_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_date")
        .text(root)
    )


def land_records(records: DataFrame, date: str, root: str) -> int:
    """Replace the date's folder with these records, one JSON object per line, every field kept.

    Raises and leaves the folder as it was when there is none. Returns the count,
    taken while writing.
    """
    if records.isEmpty():
        raise EmptySnapshot(f"no records of {date}")
    landed = Observation("landed")
    (
        records.observe(landed, F.count(F.lit(1)).alias("records"))
        .select(F.col("line").alias("value"), F.lit(date).alias("file_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_date")
        .text(root)
    )
    return landed.get["records"]
