"""What becomes of a request body, and the event-type filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.functions import json_kinds as K
from callmill.schemas import CORRUPT, STRICT_JSON

MISSING_BODY = "missing_body"
ERROR = "error"
SKIPPED = "skipped"
ACCEPTED = "accepted"

# The reply each outcome stands for.
STATUS_CODES = {MISSING_BODY: 400, ERROR: 500, SKIPPED: 200, ACCEPTED: 200}

_INTAKE_SCHEMA = f"payload struct<scheduled_event: struct<event_type: variant>>, {CORRUPT} string"


def _wrong_root(raw: Column) -> Column:
    """The document, the payload or the event is there but is no object."""
    parts = [K.child(raw, path) for path in ("$.payload", "$.payload.scheduled_event")]
    return ~(K.is_object(raw) & K.object_if_given(parts[0]) & K.object_if_given(parts[1]))


def read_event_types(requests: DataFrame) -> DataFrame:
    """Add ``event_type`` (a string, else NULL) and ``fault`` to request bodies.

    The typed read walks the text once; only a body it cannot fully read, or one
    without an event, is parsed again to see what is wrong with it.
    """
    body = F.col("body")
    given = F.col("doc.payload.scheduled_event.event_type")
    regular = F.col(f"doc.{CORRUPT}").isNull() & F.col("doc.payload.scheduled_event").isNotNull()
    regular = F.coalesce(regular, F.lit(False))
    clean = F.coalesce(F.is_valid_utf8(body) & K.ends_cleanly(body), F.lit(False))
    type_kind = K.kind(given)
    fault = (
        F.when(~F.col("clean"), True)
        .when(F.col("regular"), type_kind.isin(K.OBJECT, K.ARRAY))
        .otherwise(_wrong_root(F.col("raw")))
    )
    event_type = F.when(F.col("regular") & (type_kind == K.STRING), given.cast("string"))
    read = (
        requests.withColumn("doc", F.from_json(body, _INTAKE_SCHEMA, STRICT_JSON))
        .withColumns({"clean": clean, "regular": regular})
        .withColumn("raw", F.when(F.col("clean") & ~F.col("regular"), F.try_parse_json(body)))
    )
    # Keeps filters on the result above the reading, as in the staging step.
    found = F.struct(event_type.alias("event_type"), fault.alias("fault"))
    return read.select(*requests.columns, F.inline(F.array(found)))


def _outcome(allowed: Column) -> Column:
    return (
        F.when(F.col("body").isNull(), MISSING_BODY)
        .when(F.col("fault"), ERROR)
        .when(F.coalesce(allowed, F.lit(False)), ACCEPTED)
        .otherwise(SKIPPED)
    )


def classify(requests: DataFrame, allowed: Sequence[str] | DataFrame) -> DataFrame:
    """Add ``event_type`` and ``outcome``; every request gets exactly one.

    ``allowed`` is a short list, or a table with an ``event_type`` column for lists kept
    elsewhere; Spark broadcasts that table or not by its measured size.
    """
    read = read_event_types(requests)
    if isinstance(allowed, DataFrame):
        marks = allowed.select("event_type").distinct().withColumn("allowed", F.lit(True))
        read = read.join(marks, "event_type", "left").withColumn("outcome", _outcome(F.col("allowed"))).drop("allowed")
    else:
        read = read.withColumn("outcome", _outcome(F.col("event_type").isin(list(allowed))))
    return read.select(*requests.columns, "event_type", "outcome")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome") == ACCEPTED)


def keep_allowed(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Semi-join form of the filter, for rows that already have an event type."""
    return rows.join(allowed.select("event_type"), "event_type", "left_semi")


def outcome_counts(classified: DataFrame) -> DataFrame:
    codes = F.create_map(*[F.lit(part) for pair in STATUS_CODES.items() for part in pair])
    return (
        classified.groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select("outcome", codes[F.col("outcome")].cast("bigint").alias("status_code"), "requests")
    )
