"""The daily job as a stream over the raw folders, each file taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from callmill.plans.daily import REBUILD, Stores, ingest
from callmill.sources.documents import FILES, Layout, stream_bodies, with_folder
from callmill.streaming import batch_name


def daily_stream(
    spark: SparkSession,
    stores: Stores,
    checkpoint: str,
    layout: Layout = FILES,
    mode: str = REBUILD,
    archive: str | None = None,
    files_per_batch: int | None = None,
    take_over: bool = False,
) -> StreamingQuery:
    """Take all raw files not taken before; stops when none are left.

    The checkpoint remembers the files taken. With ``archive`` they also move there,
    the last batch's on the next run; that only tidies up, nothing depends on it.
    """
    options = {}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if files_per_batch:
        options |= {"maxFilesPerTrigger": str(files_per_batch)}
    documents = with_folder(spark, stream_bodies(spark, stores.raw, layout, **options), stores.raw)

    def take(batch: DataFrame, batch_id: int) -> None:
        ingest(spark, batch, stores, batch_name(spark, checkpoint, batch_id), mode, take_over)

    return (
        documents.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
