"""The given test tables seen as curated tables and as booking documents."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.functions.calendar import DOCUMENT_TIMESTAMP
from callmill.plans.curated import channel_map
from callmill.plans.marts import Curated
from callmill.session import scratch
from callmill.sources.tables import quoted

# Two event types of the test tables stay unmapped on purpose, and two channels have no event type.
CHANNELS = [("click", "facebook_ads"), ("purchase", "tiktok_ads"), ("signup", "youtube_ads")]
ALLOWED_EVENT_TYPES = [event_type for event_type, _ in CHANNELS]

SPEND_CHANNEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_ads' WHEN '2-HIGH' THEN 'tiktok_ads'
    WHEN '3-MEDIUM' THEN 'youtube_ads' WHEN '5-LOW' THEN 'radio' ELSE 'print' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "ts AS booking_datetime",
        "ts + make_dt_interval(0, CAST(event_id % 168 AS INT), 0, 0) AS event_datetime",
    )


def channels(spark: SparkSession) -> DataFrame:
    return channel_map(spark, CHANNELS)


def spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.expr("date_add(DATE'2024-01-01', CAST(o_orderkey % 30 AS INT))").alias("date"),
            F.expr(SPEND_CHANNEL).alias("channel"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("spend"))
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS event_id", "l_suppkey AS employee_id")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS employee_id", "s_name AS employee_name")


def curated(spark: SparkSession, sf_dir: str) -> Curated:
    return Curated(
        bookings=bookings(spark, sf_dir),
        channel_map=channels(spark),
        spends=spends(spark, sf_dir),
        memberships=memberships(spark, sf_dir),
        employees=employees(spark, sf_dir),
    )


# Booking documents made of the events table: one per event, and a later canceled
# copy of every tenth. Expressions below run alike in Spark and in DuckDB.

_ID = "CAST(event_id AS STRING)"
_USER = "CAST(user_id AS STRING)"

COPIES = "event_id % 10 = 0"

# Staged text columns under the payload, apart from timestamps.
PAYLOAD_TEXTS = {
    "cancel_url": f"'https://book.example/cancel/' || {_ID}",
    "email": f"'user' || {_USER} || '@mail.example'",
    "event": f"'e' || {_ID}",
    "first_name": f"'First' || {_USER}",
    "invitee_scheduled_by": f"CASE WHEN event_id % 6 = 0 THEN 'host' || {_USER} END",
    "last_name": f"'Last' || {_USER}",
    "name": f"CASE WHEN event_id % 17 = 0 THEN '{{First Last}} ' ELSE 'First Last ' END || {_USER}",
    "reschedule_url": f"'https://book.example/move/' || {_ID}",
    "scheduling_method": "CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'phone' END",
    "status": "CASE WHEN copy = 1 THEN 'canceled' ELSE 'active' END",
    "text_reminder_number": "CASE WHEN event_id % 8 = 0 THEN '+1 555 0100' END",
    "timezone": "CASE WHEN event_id % 2 = 0 THEN 'Europe/Berlin' ELSE 'America/New_York' END",
    "uri": f"'https://book.example/invitee/' || {_ID}",
}
EVENT_TEXTS = {
    "event_type": "event_type",
    "name": "'Call about ' || event_type",
    "status": "CASE WHEN copy = 1 THEN 'canceled' ELSE 'active' END",
    "uri": f"'https://book.example/event/' || {_ID}",
    "meeting_notes_plain": "CASE WHEN event_id % 9 = 0 THEN 'line one' || chr(10) || '\"two\"' END",
    "meeting_notes_html": "CASE WHEN event_id % 9 = 0 THEN '<p>one</p>' END",
}
COUNTER_INTS = {"total": "event_id % 5", "active": "event_id % 3", "limit": "10"}
LOCATION_TEXTS = {"location": f"'Room ' || {_USER}", "type": "CASE WHEN event_id % 2 = 0 THEN 'physical' ELSE 'call' END"}
TRACKING_TEXTS = {
    "utm_campaign": "CASE WHEN event_id % 5 = 0 THEN 'spring' END",
    "utm_source": "'src' || CAST(event_id % 7 AS STRING)",
    "utm_medium": "'cpc'",
    "utm_content": f"'ad' || {_ID}",
    "utm_term": "CASE WHEN event_id % 4 = 0 THEN 'call' END",
    "salesforce_uuid": "CASE WHEN event_id % 12 = 0 THEN 'sf' || CAST(event_id AS STRING) END",
}

# Damage, the first that applies: (events it hits, the body).
DAMAGE = [
    ("event_id % 97 = 0", "CAST(NULL AS STRING)"),
    ("event_id % 89 = 0", "'not json'"),
    ("event_id % 83 = 0", "'{\"payload\":null}'"),
    ("event_id % 79 = 0", "'{\"other\":1}'"),
]
NULL_TRACKING = "event_id % 73 = 0"


def _stamp(ts: str) -> str:
    return f"date_format({ts}, {quoted(DOCUMENT_TIMESTAMP)})"


def _fields(texts: dict[str, str]) -> list[str]:
    return [part for name, sql in texts.items() for part in (f"'{name}'", sql)]


def _object(*parts: str) -> str:
    return f"named_struct({', '.join(parts)})"


def _document_sql() -> str:
    start = "ts + make_dt_interval(0, CAST(event_id % 168 AS INT), 0, 0)"
    changed = "ts + make_dt_interval(0, copy, 0, 0)"
    event = _object(
        *_fields(EVENT_TEXTS),
        *("'created_at'", _stamp("ts"), "'updated_at'", _stamp(changed)),
        *("'start_time'", _stamp(start), "'end_time'", _stamp(f"{start} + INTERVAL 30 MINUTES")),
        # Two guests, none, not given, or given as null.
        "'event_guests'",
        "CASE event_id % 4 WHEN 0 THEN parse_json('[\"a@mail.example\",\"b@mail.example\"]')"
        " WHEN 1 THEN parse_json('[]') WHEN 3 THEN parse_json('null') END",
        "'event_memberships'",
        f"array({_object(*_fields({'user': f"'u' || {_USER}", 'user_email': f"'host' || {_USER} || '@mail.example'", 'user_name': f"'User ' || {_USER}", 'buffered_end_time': "'extra'"}))})",
        "'invitees_counter'",
        _object(*_fields(COUNTER_INTS)),
        "'location'",
        _object(*_fields(LOCATION_TEXTS)),
    )
    payload = _object(
        *_fields(PAYLOAD_TEXTS),
        *("'created_at'", _stamp("ts"), "'updated_at'", _stamp(changed)),
        *("'rescheduled'", "event_id % 3 = 0"),
        # An object on a text column, and a number on one.
        *("'no_show'", "CASE WHEN event_id % 13 = 0 THEN parse_json('{\"uri\":\"x\"}') END"),
        *("'payment'", "CASE WHEN event_id % 11 = 0 THEN event_id END"),
        "'questions_and_answers'",
        f"array({_object(*_fields({'answer': f"'a' || {_ID}", 'position': '0', 'question': "'Why?'"}))},"
        f" {_object(*_fields({'answer': 'CAST(NULL AS STRING)', 'position': '1', 'question': "'When?'"}))})",
        "'scheduled_event'",
        event,
        "'tracking'",
        f"CASE WHEN {NULL_TRACKING} THEN parse_json('null') ELSE to_variant_object({_object(*_fields(TRACKING_TEXTS))}) END",
    )
    damage = " ".join(f"WHEN {hit} THEN {body}" for hit, body in DAMAGE)
    return f"CASE {damage} ELSE to_json({_object("'event'", "'invitee.created'", "'payload'", payload)}) END"


# Where `prepare` has written the documents of a folder of tables.
_PREPARED: dict[str, str] = {}


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write the documents once, dealt over all cores, so that timings leave their making out."""
    path = scratch(spark, "documents")
    documents(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    _PREPARED[sf_dir] = path


# Events whose documents one task makes.
EVENTS_A_TASK = 100_000


def _dealt(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The events over as many tasks as they are worth: a document takes far longer to make and to read than its event, and
    a table may lie in one row group, which one task reads."""
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(events.count() / EVENTS_A_TASK))
    return events.repartition(tasks, *events.columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, copy, event_date (text) and body (NULL where a request had none)."""
    if sf_dir in _PREPARED:
        return spark.read.parquet(_PREPARED[sf_dir])
    events = _dealt(spark, table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    copied = events.withColumn(
        "copy", F.explode(F.expr(f"CASE WHEN {COPIES} THEN array(0, 1) ELSE array(0) END"))
    )
    # A filter on the body stays above its making; pushed below, it would make every document a second time.
    made = F.expr(f"array(named_struct('body', {_document_sql()}))")
    return copied.select("event_id", "copy", F.expr("CAST(to_date(ts) AS STRING) AS event_date"), F.inline(made))


def spend_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend rows as snapshot files hold them: each day has a file with that day and the two before it."""
    rows = spends(spark, sf_dir)
    last = rows.select(F.max("date").alias("last"))
    shown = rows.withColumn("day", F.explode(F.sequence("date", F.date_add("date", 2))))
    # One row with the last day: there is no file of a later one.
    return shown.join(last, F.col("day") <= F.col("last")).select(
        F.concat(F.lit("spend_data_"), F.col("day").cast("string"), F.lit(".json")).alias("file"),
        F.col("date").cast("string").alias("date"),
        "channel",
        "spend",
    )
