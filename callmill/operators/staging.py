"""Documents to typed staging rows, with a reason for every document refused.

Every document is read once by ``from_json`` with the document schema. A document that
fits it and has all its parts needs no more. If a part is NULL the text is also
parsed to VARIANT, to tell absent from given as null. Only a document that does
not fit the schema is searched for the value of a wrong kind, since some of them
are harmless. CASE keeps each cost off the documents that do not need it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.functions import json_kinds as K
from callmill.functions.calendar import document_timestamp
from callmill.schemas import CORRUPT, DOCUMENT_SCHEMA, LANDED, PARTITION, STAGED, STRICT_JSON

REASON = "reason"

# A document that lies in no batch folder has no date to be stored under.
NO_FOLDER = "no_batch_folder"

TOP_TEXTS = [path for type_, path in STAGED.values() if isinstance(type_, T.StringType) and "." not in path]

# Lists of an event, and the flag that says one is absent.
LISTS = {"scheduled_event.event_guests": "no_guests", "scheduled_event.event_memberships": "no_members"}

_PAYLOAD = "$.payload"
_EVENT = "$.payload.scheduled_event"


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


# Any text that may stand for an object, as its first character says.
_OBJECT_LIKE = f"coalesce({' OR '.join(f"startswith(doc.payload.{path}, '{{')" for path in TOP_TEXTS)}, false)"


def _is_regular() -> Column:
    """Fits the schema, has every part, and no text that may stand for an object."""
    payload = F.col("doc.payload")
    event = payload["scheduled_event"]
    parts = ("event_guests", "event_memberships", "invitees_counter", "location")
    return (
        F.col("doc").isNotNull()
        & F.col(f"doc.{CORRUPT}").isNull()
        & payload["tracking"].isNotNull()
        & (event.isNull() | reduce(lambda a, b: a & b, [event[part].isNotNull() for part in parts]))
        & ~F.col("object_like")
    )


def _wrong_int(value: Column) -> Column:
    """Not an integer that fits the column; absent and null are fine."""
    fits = F.try_variant_get(value, "$", "int").isNotNull()
    return ~F.when(fits, K.kind(value) == K.INTEGER).otherwise(K.kind(value).isin(K.MISSING, K.NULL))


def _wrong_list(value: Column, element_is_wrong=None, object_is_fine: bool = False) -> Column:
    fine = [K.MISSING, K.NULL, K.ARRAY] + ([K.OBJECT] if object_is_fine else [])
    wrong = ~K.kind(value).isin(fine)
    if element_is_wrong is not None:
        wrong = wrong | F.coalesce(F.exists(K.elements(value), element_is_wrong), F.lit(False))
    return wrong


def _wrong_member(member: Column) -> Column:
    return ~K.kind(member).isin(K.OBJECT, K.NULL)


def _wrong_answer(answer: Column) -> Column:
    return _wrong_member(answer) | _wrong_int(K.child(answer, "$.position"))


def _null_part(raw: Column) -> Column:
    """For documents that fit the schema: the part that was given as null, if any."""
    payload = F.col("doc.payload")
    event = payload["scheduled_event"]

    def given_as_null(part: Column, path: str) -> Column:
        return part.isNull() & F.is_variant_null(K.child(raw, path))

    return (
        F.when(raw.isNull(), "malformed")
        .when(given_as_null(payload, _PAYLOAD), "payload_not_object")
        .when(
            event.isNotNull() & given_as_null(event["invitees_counter"], f"{_EVENT}.invitees_counter"),
            "invitees_counter_not_object",
        )
        .when(event.isNotNull() & given_as_null(event["location"], f"{_EVENT}.location"), "location_not_object")
        .when(given_as_null(payload["tracking"], f"{_PAYLOAD}.tracking"), "tracking_not_object")
    )


def _misfit(raw: Column) -> Column:
    """For documents that do not fit the schema: why, or NULL if it does no harm."""
    event = K.child(raw, _EVENT)
    counter = K.child(raw, f"{_EVENT}.invitees_counter")
    rescheduled = K.child(raw, f"{_PAYLOAD}.rescheduled")
    has_event = K.is_object(event)
    return (
        F.when(raw.isNull(), "malformed")
        .when(~K.is_object(raw), "document_not_object")
        .when(~K.object_if_given(K.child(raw, _PAYLOAD)), "payload_not_object")
        .when(~has_event & ~K.is_empty(event), "scheduled_event_not_object")
        .when(has_event & ~K.object_if_given(counter), "invitees_counter_not_object")
        .when(has_event & ~K.object_if_given(K.child(raw, f"{_EVENT}.location")), "location_not_object")
        .when(~K.object_if_given(K.child(raw, f"{_PAYLOAD}.tracking")), "tracking_not_object")
        .when(~K.kind(rescheduled).isin(K.MISSING, K.NULL, K.BOOLEAN, K.OBJECT), "rescheduled_wrong_type")
        .when(
            _any([_wrong_int(K.child(counter, f"$.{name}")) for name in ("total", "active", "limit")]),
            "invitees_counter_wrong_type",
        )
        .when(
            _wrong_list(K.child(raw, f"{_PAYLOAD}.questions_and_answers"), _wrong_answer, object_is_fine=True),
            "questions_wrong_type",
        )
        .when(has_event & _wrong_list(K.child(event, "$.event_guests")), "guests_wrong_type")
        .when(has_event & _wrong_list(K.child(event, "$.event_memberships"), _wrong_member), "members_wrong_type")
    )


def _staged(name: str, type_: T.DataType, path: str) -> Column:
    value = f"read.doc.payload.{path}"
    if isinstance(type_, T.TimestampType):
        return document_timestamp(F.col(value)).alias(name)
    if path in LISTS:
        # An absent list of a given event is empty; a null list, or one of no event, is NULL.
        value = f"if(read.fixes.{LISTS[path]}, CAST(array() AS {type_.simpleString()}), {value})"
    elif path in TOP_TEXTS:
        # Text of a scalar or list; an object's leaves have other names, so it is NULL.
        value = f"if(array_contains(read.fixes.objects, '{path}'), NULL, {value})"
    return F.expr(f"{value} AS {name}")


def _fixes(raw: Column) -> Column:
    """What the typed read cannot tell, for irregular documents; NULL for the others."""
    payload = F.col("doc.payload")
    event = payload["scheduled_event"]
    # An event without any key counts as none.
    given = event.isNotNull() & (event["event_type"].isNotNull() | (K.child(raw, _EVENT).cast("string") != "{}"))
    fields = F.try_variant_get(raw, _PAYLOAD, "map<string, variant>")
    objects = F.map_keys(F.map_filter(fields, lambda _, field: K.is_object(field)))
    return F.when(
        raw.isNotNull(),
        F.struct(
            F.when(F.col("object_like"), objects).alias("objects"),
            *[(given & K.child(raw, f"{_PAYLOAD}.{path}").isNull()).alias(flag) for path, flag in LISTS.items()],
        ),
    )


def read_documents(documents: DataFrame) -> DataFrame:
    """Add ``read``: the typed document, its fixes, and the reason it is refused, if any."""
    body = F.col("body")
    readable = F.coalesce(F.is_valid_utf8(body) & K.ends_cleanly(body), F.lit(False))
    irregular = ~F.coalesce(_is_regular(), F.lit(False))
    fits = F.col(f"doc.{CORRUPT}").isNull()
    reason = (
        F.when(~F.col("readable"), "malformed")
        .when(F.col("irregular") & fits, _null_part(F.col("raw")))
        .when(F.col("irregular"), _misfit(F.col("raw")))
    )
    read = (
        documents.withColumn("doc", F.from_json(body, DOCUMENT_SCHEMA, STRICT_JSON))
        .withColumns({"readable": readable, "object_like": F.expr(_OBJECT_LIKE)})
        .withColumn("irregular", irregular)
        .withColumn("raw", F.when(F.col("readable") & F.col("irregular"), F.try_parse_json(body)))
    )
    found = F.struct("doc", _fixes(F.col("raw")).alias("fixes"), reason.alias(REASON))
    # One row in, one row out. A filter on the reason stays above this step; pushed
    # below, it would read every document a second time.
    return read.select(*documents.columns, F.explode(F.array(found)).alias("read"))


def stage_documents(documents: DataFrame) -> DataFrame:
    """Documents (``body``, ``event_date``, …) to staging columns plus ``reason``.

    Columns of the input stay; a refused document has a reason and its text, a
    staged one neither. No shuffle.
    """
    read = read_documents(documents)
    kept = [name for name in documents.columns if name not in ("body", PARTITION)]
    reason = F.when(F.col(PARTITION) == "", NO_FOLDER).otherwise(F.col(f"read.{REASON}"))
    return read.select(
        *kept,
        reason.alias(REASON),
        F.when(reason.isNotNull(), F.col("body")).alias("body"),
        *[_staged(name, type_, path) for name, (type_, path) in STAGED.items()],
        F.col(PARTITION).cast("string").alias(PARTITION),
    )


def staged_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col(REASON).isNull()).select(*STAGED, PARTITION)


def refused_rows(staged: DataFrame) -> DataFrame:
    """The quarantine branch: what came in, from where, under which landed name, and why it was refused."""
    landed = F.col(LANDED) if LANDED in staged.columns else F.lit(None).cast("string").alias(LANDED)
    return staged.where(F.col(REASON).isNotNull()).select("source_file", landed, REASON, "body", PARTITION)
