"""Booking documents: request bodies and the raw landing folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.functions.calendar import LANDED_LENGTH, LANDED_NAME, arrival_date, landed_name
from callmill.schemas import LANDED, PARTITION
from callmill.sources.files import batch_folder, literal


@dataclass(frozen=True)
class Layout:
    """How documents lie in files: the suffix taken, and one per file or per line."""

    suffix: str
    per_file: bool


# One document per file, whatever its line breaks.
FILES = Layout(".json", per_file=True)
# One document per line of larger files, as the landing writer packs them; splittable.
LINES = Layout(".txt", per_file=False)
# The same, compressed: a tenth of the disk. One task reads a file, so files must be of moderate size.
GZIPPED = Layout(".txt.gz", per_file=False)

ARRIVAL = "ingest_date"


def bodies(spark: SparkSession, path: str, layout: Layout = FILES) -> DataFrame:
    """Texts as ``body``, and the name they landed under as ``landed`` if they have one."""
    return _named(_reader(spark.read, layout).text(path, wholetext=layout.per_file))


def stream_bodies(spark: SparkSession, path: str, layout: Layout = FILES, **options: str) -> DataFrame:
    reader = _reader(spark.readStream, layout).options(**options)
    return _named(reader.text(path, wholetext=layout.per_file))


def _named(texts: DataFrame) -> DataFrame:
    """A landed line is a name, a tab and the document; any other text is a document alone."""
    value = F.col("value")
    # A name has a fixed length, so most texts are told by one character.
    named = (F.substring(value, LANDED_LENGTH + 1, 1) == "\t") & F.substring(value, 1, LANDED_LENGTH).rlike(LANDED_NAME)
    named = F.coalesce(named, F.lit(False))
    return texts.withColumns(
        {
            LANDED: F.when(named, F.substring(value, 1, LANDED_LENGTH)),
            "body": F.when(named, F.substr(value, F.lit(LANDED_LENGTH + 2))).otherwise(value),
        }
    ).drop("value")


def _reader(reader, layout: Layout):
    # The glob is case-sensitive and applies to file names at any depth.
    return reader.option("pathGlobFilter", f"*{layout.suffix}").option("recursiveFileLookup", "true")


def with_folder(spark: SparkSession, documents: DataFrame, root: str) -> DataFrame:
    """Add the batch folder as ``event_date`` ('' for a loose file) and the file name."""
    return documents.select(
        F.col("_metadata.file_path").alias("source_file"),
        LANDED,
        "body",
        batch_folder(spark, root).alias(PARTITION),
    )


def raw_documents(spark: SparkSession, root: str, layout: Layout = FILES) -> DataFrame:
    """All pending batches in one scan: source_file, landed, body, event_date."""
    return with_folder(spark, bodies(spark, root, layout), root)


def pending_documents(spark: SparkSession, root: str, layout: Layout, paths: list[str] | None) -> DataFrame:
    """The documents of these files of the raw folder; None for all of them."""
    if paths is None:
        return raw_documents(spark, root, layout)
    if not paths:
        return spark.createDataFrame([], f"source_file string, {LANDED} string, body string, {PARTITION} string")
    given = spark.read.text([literal(path) for path in paths], wholetext=layout.per_file)
    return with_folder(spark, _named(given), root)


def one_line(body: Column) -> Column:
    """A JSON text without line breaks; inside strings JSON has none to lose."""
    return F.translate(body, "\r\n", "  ")


def arriving(accepted: DataFrame) -> DataFrame:
    """Accepted documents ready to land: the arrival date, and one line of the name it lands under, a tab and the text.

    The name is the document's own, its stamp that of the batch: a row that is refused later can be traced to it.
    """
    line = F.concat(landed_name(), F.lit("\t"), one_line(F.col("body")))
    return accepted.select(arrival_date().alias(ARRIVAL), line.alias("value"))


def land(accepted: DataFrame, root: str) -> None:
    """Append accepted documents to the folder of their UTC arrival date.

    Every task writes one uniquely named file of many documents. They share one
    date, so there is nothing to shuffle.
    """
    arriving(accepted).write.mode("append").partitionBy(ARRIVAL).text(root)
