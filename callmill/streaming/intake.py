"""Streaming intake: request bodies as they arrive, to the raw landing folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callmill.operators.intake import STATUS_CODES, accepted, classify
from callmill.plans.landing import outcome_metrics
from callmill.sources import files
from callmill.sources.documents import ARRIVAL, FILES, Layout, arriving, stream_bodies
from callmill.streaming import batch_name

BATCH = "batch"
OUTCOMES_SCHEMA = "batch string, " + ", ".join(f"{outcome} bigint" for outcome in STATUS_CODES)


def land_stream(
    spark: SparkSession,
    requests: str,
    root: str,
    checkpoint: str,
    allowed: Sequence[str] | DataFrame,
    layout: Layout = FILES,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take all bodies waiting in ``requests``; stops when none are left.

    Each batch owns a folder below its arrival date and replaces it when it is
    repeated. The arrival date is the batch's own clock, so a repeat after midnight
    finds the same folder. Its outcome counts are a row of their own beside the checkpoint,
    replaced with it.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(spark, checkpoint, batch_id)
        outcomes = Observation("intake")
        (
            arriving(accepted(batch.observe(outcomes, *outcome_metrics())))
            .withColumn(BATCH, F.lit(name))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(ARRIVAL, BATCH)
            .text(root)
        )
        counts = outcomes.get
        row = batch.sparkSession.range(1).select(
            F.lit(name).alias("batch"), *[F.lit(counts[o]).cast("bigint").alias(o) for o in STATUS_CODES]
        )
        row.write.mode("overwrite").json(f"{outcomes_path(checkpoint)}/{name}")

    return (
        classify(stream_bodies(spark, requests, layout, **options), allowed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def outcomes_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-outcomes"


def batch_outcomes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per batch taken under a checkpoint, however many there were."""
    if not files.child_folders(spark, outcomes_path(checkpoint)):
        return spark.createDataFrame([], OUTCOMES_SCHEMA)
    return spark.read.schema(OUTCOMES_SCHEMA).json(outcomes_path(checkpoint), recursiveFileLookup=True)


def outcomes_of(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Requests per outcome over all batches of a checkpoint."""
    totals = batch_outcomes(spark, checkpoint).agg(*[F.sum(o).alias(o) for o in STATUS_CODES]).first()
    return {outcome: totals[outcome] or 0 for outcome in STATUS_CODES}
