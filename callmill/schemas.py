"""Fixed schemas of documents, the staging table and the landed spends."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()

QUESTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("answer", TEXT),
            T.StructField("position", T.IntegerType()),
            T.StructField("question", TEXT),
        ]
    )
)
MEMBERS = T.ArrayType(
    T.StructType([T.StructField("user", TEXT), T.StructField("user_email", TEXT), T.StructField("user_name", TEXT)])
)
COUNTER = T.StructType([T.StructField(name, T.IntegerType()) for name in ("total", "active", "limit")])
LOCATION = T.StructType([T.StructField("location", TEXT), T.StructField("type", TEXT)])

# The staging columns in order. Each maps to its type and to the path
# below the payload that fills it.
STAGED = {
    "cancel_url": (TEXT, "cancel_url"),
    "created_at": (T.TimestampType(), "created_at"),
    "email": (TEXT, "email"),
    "event": (TEXT, "event"),
    "first_name": (TEXT, "first_name"),
    "invitee_scheduled_by": (TEXT, "invitee_scheduled_by"),
    "last_name": (TEXT, "last_name"),
    "name": (TEXT, "name"),
    "new_invitee": (TEXT, "new_invitee"),
    "no_show": (TEXT, "no_show"),
    "old_invitee": (TEXT, "old_invitee"),
    "payment": (TEXT, "payment"),
    "questions_and_answers": (QUESTIONS, "questions_and_answers"),
    "reconfirmation": (TEXT, "reconfirmation"),
    "reschedule_url": (TEXT, "reschedule_url"),
    "rescheduled": (T.BooleanType(), "rescheduled"),
    "routing_form_submission": (TEXT, "routing_form_submission"),
    "scheduled_event_created_at": (T.TimestampType(), "scheduled_event.created_at"),
    "scheduled_event_end_time": (T.TimestampType(), "scheduled_event.end_time"),
    "scheduled_event_event_guests": (T.ArrayType(TEXT), "scheduled_event.event_guests"),
    "scheduled_event_event_memberships": (MEMBERS, "scheduled_event.event_memberships"),
    "scheduled_event_event_type": (TEXT, "scheduled_event.event_type"),
    "scheduled_event_invitees_counter_total": (T.IntegerType(), "scheduled_event.invitees_counter.total"),
    "scheduled_event_invitees_counter_active": (T.IntegerType(), "scheduled_event.invitees_counter.active"),
    "scheduled_event_invitees_counter_limit": (T.IntegerType(), "scheduled_event.invitees_counter.limit"),
    "scheduled_event_location_location": (TEXT, "scheduled_event.location.location"),
    "scheduled_event_location_type": (TEXT, "scheduled_event.location.type"),
    "scheduled_event_meeting_notes_html": (TEXT, "scheduled_event.meeting_notes_html"),
    "scheduled_event_meeting_notes_plain": (TEXT, "scheduled_event.meeting_notes_plain"),
    "scheduled_event_name": (TEXT, "scheduled_event.name"),
    "scheduled_event_start_time": (T.TimestampType(), "scheduled_event.start_time"),
    "scheduled_event_status": (TEXT, "scheduled_event.status"),
    "scheduled_event_updated_at": (T.TimestampType(), "scheduled_event.updated_at"),
    "scheduled_event_uri": (TEXT, "scheduled_event.uri"),
    "scheduling_method": (TEXT, "scheduling_method"),
    "status": (TEXT, "status"),
    "text_reminder_number": (TEXT, "text_reminder_number"),
    "timezone": (TEXT, "timezone"),
    "tracking_utm_campaign": (TEXT, "tracking.utm_campaign"),
    "tracking_utm_source": (TEXT, "tracking.utm_source"),
    "tracking_utm_medium": (TEXT, "tracking.utm_medium"),
    "tracking_utm_content": (TEXT, "tracking.utm_content"),
    "tracking_utm_term": (TEXT, "tracking.utm_term"),
    "tracking_salesforce_uuid": (TEXT, "tracking.salesforce_uuid"),
    "updated_at": (T.TimestampType(), "updated_at"),
    "uri": (TEXT, "uri"),
}

PARTITION = "event_date"

# Filled where a document does not fit the schema below.
CORRUPT = "_unread"

STAGING_SCHEMA = T.StructType(
    [T.StructField(name, type_) for name, (type_, _) in STAGED.items()] + [T.StructField(PARTITION, TEXT)]
)


def _document_schema() -> T.StructType:
    """The document's own nesting, as the staged paths spell it out."""
    nested = {"invitees_counter": COUNTER, "location": LOCATION}
    top: dict[str, T.DataType] = {}
    event: dict[str, T.DataType] = {}
    tracking: dict[str, T.DataType] = {}
    for type_, path in STAGED.values():
        # Timestamps arrive as text.
        leaf = TEXT if isinstance(type_, T.TimestampType) else type_
        match path.split("."):
            case [name]:
                top[name] = leaf
            case ["tracking", name]:
                tracking[name] = leaf
            case ["scheduled_event", name, *rest]:
                event[name] = nested[name] if rest else leaf
    top["scheduled_event"] = _struct(event)
    top["tracking"] = _struct(tracking)
    return _struct({"payload": _struct(top), CORRUPT: TEXT})


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in fields.items()])



DOCUMENT_SCHEMA = _document_schema()

# Strict JSON, as the documents' own reader has it.
STRICT_JSON = {
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# The name a document landed under, if it came by the intake.
LANDED = "landed"

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("source_file", TEXT),
        T.StructField(LANDED, TEXT),
        T.StructField("reason", TEXT),
        T.StructField("body", TEXT),
        T.StructField(PARTITION, TEXT),
    ]
)

SPEND_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("channel", TEXT),
        T.StructField("spend", T.DecimalType(18, 2)),
        T.StructField("file_date", T.DateType()),
    ]
)
