"""Batch intake: classify request bodies and land the accepted ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from callmill.operators.intake import STATUS_CODES, accepted, classify
from callmill.sources.documents import land


def outcome_metrics() -> list:
    """One count per outcome, for ``observe``."""
    return [F.count_if(F.col("outcome") == outcome).alias(outcome) for outcome in STATUS_CODES]


def intake(requests: DataFrame, allowed: Sequence[str] | DataFrame, root: str) -> dict[str, int]:
    """Land accepted documents; returns requests per outcome, counted on the way."""
    outcomes = Observation("intake")
    land(accepted(classify(requests, allowed).observe(outcomes, *outcome_metrics())), root)
    return outcomes.get
