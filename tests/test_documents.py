"""One small document per rule: what the daily job makes of it, and the intake."""

import json

import pytest
from pyspark.sql import functions as F

from callmill.operators import intake
from callmill.operators.staging import refused_rows, stage_documents, staged_rows
from callmill.schemas import STAGED, STAGING_SCHEMA
from callmill.sources import documents

EVENT = {
    "event_type": "A",
    "event_guests": [],
    "event_memberships": [],
    "invitees_counter": {},
    "location": {},
}


def doc(**payload):
    return json.dumps({"payload": {"tracking": {}, **payload}})


def with_event(**event):
    return doc(scheduled_event={**EVENT, **event})


def without(name):
    return doc(scheduled_event={k: v for k, v in EVENT.items() if k != name})


@pytest.fixture(scope="module")
def stage(spark):
    def run(*bodies):
        rows = spark.createDataFrame([(i, b, "2024-01-01") for i, b in enumerate(bodies)], "i int, body string, event_date string")
        found = stage_documents(rows.withColumn("source_file", F.lit("f"))).orderBy("i").collect()
        assert len(found) == len(bodies)
        return found

    return run


REFUSED = [
    ("", "malformed"),
    ("   ", "malformed"),
    ("not json", "malformed"),
    ("{'payload':{}}", "malformed"),
    ('{"payload":{},}', "malformed"),
    ('{"payload":{"name":NaN}}', "malformed"),
    ('{"payload":{"name":"a\nb"}}', "malformed"),
    ('{"payload":{}} trailing', "malformed"),
    ('{"payload":{}}{"payload":{}}', "malformed"),
    ('{"payload":{}},{"payload":{}}', "malformed"),
    ('{"payload":{}}]', "malformed"),
    # Texts that would go on inside or behind the wrapping in which a document is read.
    (doc() + ',"k":null', "malformed"),
    (doc() + ',"document":' + doc(), "malformed"),
    (doc() + '},"x":{"w":{"k":1}', "malformed"),
    (doc() + ',"k":null},"x":{"y":1', "malformed"),
    (doc()[:-1], "malformed"),
    ('﻿{"payload":{}}', "malformed"),
    ("[]", "document_not_object"),
    ('[{"payload":{}}]', "document_not_object"),
    ('""', "document_not_object"),
    ("null", "document_not_object"),
    ("5", "document_not_object"),
    ('{"payload":null}', "payload_not_object"),
    ('{"payload":[]}', "payload_not_object"),
    ('{"payload":"x"}', "payload_not_object"),
    (doc(scheduled_event="x"), "scheduled_event_not_object"),
    (doc(scheduled_event="false"), "scheduled_event_not_object"),
    (doc(scheduled_event="{}"), "scheduled_event_not_object"),
    (doc(scheduled_event=5), "scheduled_event_not_object"),
    (doc(scheduled_event=0.5), "scheduled_event_not_object"),
    (doc(scheduled_event=True), "scheduled_event_not_object"),
    (doc(scheduled_event=[0]), "scheduled_event_not_object"),
    (with_event(invitees_counter=None), "invitees_counter_not_object"),
    (with_event(invitees_counter=[]), "invitees_counter_not_object"),
    (with_event(location=None), "location_not_object"),
    (with_event(location="here"), "location_not_object"),
    (doc(tracking=None), "tracking_not_object"),
    (doc(tracking=[]), "tracking_not_object"),
    (doc(tracking=""), "tracking_not_object"),
    (doc(rescheduled="true"), "rescheduled_wrong_type"),
    (doc(rescheduled=1), "rescheduled_wrong_type"),
    (doc(rescheduled=[]), "rescheduled_wrong_type"),
    (with_event(invitees_counter={"total": "5"}), "invitees_counter_wrong_type"),
    (with_event(invitees_counter={"total": 5.0}), "invitees_counter_wrong_type"),
    (with_event(invitees_counter={"active": True}), "invitees_counter_wrong_type"),
    (with_event(invitees_counter={"limit": 3_000_000_000}), "invitees_counter_wrong_type"),
    (with_event(invitees_counter={"limit": {}}), "invitees_counter_wrong_type"),
    (doc(questions_and_answers="x"), "questions_wrong_type"),
    (doc(questions_and_answers=["x"]), "questions_wrong_type"),
    (doc(questions_and_answers=[{"position": "1"}]), "questions_wrong_type"),
    (with_event(event_guests="x"), "guests_wrong_type"),
    (with_event(event_guests={}), "guests_wrong_type"),
    (with_event(event_memberships="x"), "members_wrong_type"),
    (with_event(event_memberships=["x"]), "members_wrong_type"),
]


def test_refused(stage):
    rows = stage(*[body for body, _ in REFUSED])
    for (body, reason), row in zip(REFUSED, rows, strict=True):
        assert (body, row.reason) == (body, reason)
        assert row.body == body


EVENT_FIELDS = [name for name in STAGED if name.startswith("scheduled_event_")]
GUESTS = "scheduled_event_event_guests"
MEMBERS = "scheduled_event_event_memberships"

STAGED_VALUES = [
    # A document without a payload is a row without values.
    ('{"other":1}', dict.fromkeys(STAGED)),
    ("{}", dict.fromkeys(STAGED)),
    ('  {"payload":{}}\n', dict.fromkeys(STAGED)),
    # Absent lists of an event are empty, null lists NULL; no event has neither.
    ('{"payload":{"scheduled_event":{"event_type":"A"}}}', {GUESTS: [], MEMBERS: [], "scheduled_event_event_type": "A"}),
    ('{"payload":{"scheduled_event":{"name":"B"}}}', {GUESTS: [], MEMBERS: [], "scheduled_event_name": "B"}),
    ('{"payload":{"scheduled_event":{"extra":1}}}', {GUESTS: [], MEMBERS: []}),
    ('{"payload":{"scheduled_event":{"event_type":"A","event_guests":null}}}', {GUESTS: None, MEMBERS: []}),
    (with_event(event_memberships=None), {GUESTS: [], MEMBERS: None}),
    *[(doc(scheduled_event=empty), dict.fromkeys(EVENT_FIELDS)) for empty in (None, {}, [], "", 0, 0.0, False)],
    (without("location"), {"scheduled_event_location_type": None, "scheduled_event_event_type": "A"}),
    (without("invitees_counter"), {"scheduled_event_invitees_counter_total": None}),
    # An object on a payload text is NULL, a scalar its text, a list JSON text.
    (doc(payment={"amount": 1}), {"payment": None}),
    (doc(payment={}), {"payment": None}),
    (doc(name="{x"), {"name": "{x"}),
    (doc(name='{"a":1}'), {"name": '{"a":1}'}),
    (doc(name=5, email=True, status=5.0), {"name": "5", "email": "true", "status": "5.0"}),
    (doc(name=[1, "a"]), {"name": '[1,"a"]'}),
    (with_event(name={"a": 1}), {"scheduled_event_name": '{"a":1}'}),
    (doc(tracking={"utm_source": ["x"]}), {"tracking_utm_source": '["x"]'}),
    # An object on the flag or the answers has other leaves, too.
    (doc(rescheduled={"a": 1}), {"rescheduled": None}),
    (doc(rescheduled=False), {"rescheduled": False}),
    (doc(questions_and_answers={"a": 1}), {"questions_and_answers": None}),
    (doc(questions_and_answers=[None, {"position": 1, "extra": 2}]), {"questions_and_answers": [None, (None, 1, None)]}),
    (with_event(event_guests=["a", {"email": "b"}, None, 5]), {GUESTS: ["a", '{"email":"b"}', None, "5"]}),
    (with_event(event_memberships=[{"user": "u", "user_name": "n", "x": 1}]), {MEMBERS: [("u", None, "n")]}),
    (with_event(invitees_counter={"total": 5, "active": None}), {"scheduled_event_invitees_counter_total": 5}),
    # The last of two equal keys wins.
    ('{"payload":{"name":"a","name":"b"}}', {"name": "b"}),
    ('{"payload":null,"payload":{"name":"b"}}', {"name": "b"}),
    # Only the documented paths fill a column.
    ('{"payload":{"first":{"name":"x"},"scheduled_event_name":"y"}}', {"first_name": None, "scheduled_event_name": None}),
    # The folder's date wins over the payload's own.
    (doc(event_date="1999-01-01"), {"event_date": "2024-01-01"}),
]


def _plain(value):
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return tuple(value) if isinstance(value, tuple) else value


def test_staged_values(stage):
    rows = stage(*[body for body, _ in STAGED_VALUES])
    for (body, expected), row in zip(STAGED_VALUES, rows, strict=True):
        assert (body, row.reason, row.body) == (body, None, None)
        assert {name: _plain(row[name]) for name in expected} == expected, body


def test_timestamps(stage):
    parsed = ["2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05.123Z"]
    unparsed = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.1234567Z", "2024-01-02T03:04:05.123456+00:00", "", "junk"]
    rows = stage(*[doc(created_at=text) for text in parsed + unparsed])
    assert [row.created_at.isoformat() for row in rows[:2]] == ["2024-01-02T03:04:05.123456", "2024-01-02T03:04:05.123000"]
    assert [row.created_at for row in rows[2:]] == [None] * len(unparsed)
    assert not any(row.reason for row in rows)


def test_invalid_utf8_is_refused(spark, tmp_path):
    (tmp_path / "raw" / "2024-01-01").mkdir(parents=True)
    (tmp_path / "raw" / "2024-01-01" / "a.json").write_bytes(b'{"payload":{"name":"\xff\xfe"}}')
    staged = stage_documents(documents.raw_documents(spark, str(tmp_path / "raw")))
    assert [row.reason for row in staged.select("reason").collect()] == ["malformed"]


def test_staging_schema(spark, stage):
    rows = spark.createDataFrame([("{}", "2024-01-01", "f")], "body string, event_date string, source_file string")
    staged = stage_documents(rows)
    assert [(f.name, f.dataType) for f in staged_rows(staged).schema] == [(f.name, f.dataType) for f in STAGING_SCHEMA]
    assert len(STAGING_SCHEMA) == 47
    assert refused_rows(staged).count() == 0


OUTCOMES = [
    (None, "missing_body"),
    ("", "error"),
    ("not json", "error"),
    ("[]", "error"),
    ('""', "error"),
    ("null", "error"),
    ("5", "error"),
    ('{"payload":null}', "error"),
    ('{"payload":[]}', "error"),
    ('{"payload":{"scheduled_event":null}}', "error"),
    ('{"payload":{"scheduled_event":[]}}', "error"),
    ('{"payload":{"scheduled_event":""}}', "error"),
    ('{"payload":{"scheduled_event":{"event_type":["A"]}}}', "error"),
    ('{"payload":{"scheduled_event":{"event_type":{"A":1}}}}', "error"),
    ('{"payload":{"scheduled_event":{"event_type":"A"}}} x', "error"),
    ("{}", "skipped"),
    ('{"payload":{}}', "skipped"),
    ('{"payload":{"scheduled_event":{}}}', "skipped"),
    ('{"payload":{"scheduled_event":{"event_type":null}}}', "skipped"),
    ('{"payload":{"scheduled_event":{"event_type":"B"}}}', "skipped"),
    ('{"payload":{"scheduled_event":{"event_type":5}}}', "skipped"),
    ('{"payload":{"scheduled_event":{"event_type":"A"}}}', "accepted"),
    ('{"payload":{"scheduled_event":{"event_type":"5"}},"x":null}', "accepted"),
]


@pytest.mark.parametrize("form", ["list", "table"])
def test_outcomes(spark, form):
    requests = spark.createDataFrame([(i, body) for i, (body, _) in enumerate(OUTCOMES)], "i int, body string")
    allowed = ["A", "5"] if form == "list" else spark.createDataFrame([("A",), ("5",), ("A",)], "event_type string")
    rows = intake.classify(requests, allowed).orderBy("i").collect()
    assert [(row.body, row.outcome) for row in rows] == OUTCOMES


def test_outcome_counts_add_up(spark):
    requests = spark.createDataFrame([(body,) for body, _ in OUTCOMES], "body string")
    counts = intake.outcome_counts(intake.classify(requests, ["A"])).collect()
    assert sum(row.requests for row in counts) == len(OUTCOMES)
    assert {row.outcome: row.status_code for row in counts} == intake.STATUS_CODES
