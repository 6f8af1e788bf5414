"""Settings and small helpers that the operators share."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.session import configure, scratch

# What Spark hands to Python at a time: texts have no length limit, so bytes count, not rows.
BYTES_PER_BATCH = "4m"


def prepare(spark: SparkSession) -> SparkSession:
    spark = configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here and
    lost executors lose nothing."""
    path = scratch(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The operator whose lookups this Python worker holds, and how to drop them.
_LOOKUPS: list[tuple[str, Callable[[], None]]] = []


def holds_lookups(operator: str, drop: Callable[[], None]) -> None:
    """Call before lookups are used that stay in the worker from one task to the next.

    Spark gives a worker to one operator after the other; the lookups of the one before are dropped, so that a
    worker never holds those of several.
    """
    if not _LOOKUPS or _LOOKUPS[0][0] != operator:
        for _, drop_others in _LOOKUPS:
            drop_others()
        _LOOKUPS[:] = [(operator, drop)]


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def matched(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of both sides where null equals null; the key columns come out once, from the left."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}" if c in names else c) for c in right.columns])
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{c}" for c in names])


def whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row, and the row itself as the struct `_row`, whatever else it is made of."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("_text"),
    )


def with_text(df: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """`columns` of the struct `_row` with another text; n_chars follows a text that changed."""
    df = df.withColumn("_new", text)
    old = F.col("_row")["text"]
    named = {"text": F.col("_new").alias("text")}
    if "n_chars" in columns:
        same = F.col("_new").eqNullSafe(old)
        count = F.when(same, F.col("_row")["n_chars"]).otherwise(F.length("_new"))
        named["n_chars"] = count.cast(df.schema["_row"].dataType["n_chars"].dataType).alias("n_chars")
    return df.select(*[named.get(c, F.col("_row")[c].alias(c)) for c in columns])


def removed(df: DataFrame) -> None:
    """Delete the files of a table made by `saved` that nothing will read again."""
    session = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = session.sparkContext._jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def settled(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that are over.

    It does so when the driver's garbage collector finds them unused, which on a quiet driver may be
    long after; between the large steps of one operator that would hold a multiple of the input on disk.
    """
    gc.collect()  # DataFrames that Python still holds in cycles hold their shuffles
    spark.range(1).count()  # the last job's plan is held until there is another
    for _ in range(2):
        time.sleep(1)  # the JVM is told of freed objects by a thread of its own, and files go a little later
        spark.sparkContext._jvm.System.gc()
