"""One row per key, the same one whatever order the rows arrive in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmill.schemas import PARTITION


def best_per_key(rows: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """The row with the largest ``latest`` columns per key; NULL keys are one key.

    The remaining columns break ties, so only equal rows can take each other's
    place. Ranking to one lets Spark drop losers before the shuffle: a key with
    many copies sends at most one row per input split.
    """
    ranked_by = [*latest, *[c for c in rows.columns if c not in keys and c not in latest]]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranked_by])
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_bookings(staging: DataFrame) -> DataFrame:
    """One staging row per folder date and event."""
    return best_per_key(staging, [PARTITION, "event"], ["updated_at", "created_at", "uri"])
