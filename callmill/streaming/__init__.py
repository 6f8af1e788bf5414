"""Available-now streaming forms of the intake and of the daily job."""

from __future__ import annotations

from pyspark.sql import SparkSession


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name that a repeated batch gets again, and no batch of another checkpoint.

    Batch numbers start over with a new checkpoint; the id it keeps for its query
    does not come back.
    """
    query_id = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
    return f"{query_id}-{batch_id}"
