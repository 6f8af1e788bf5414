"""DuckDB SQL for the registered queries, over the same tables.

The marts keep the plain join of bookings to every spend row of their channel,
so the factored form in the library is what gets tested.
"""

from __future__ import annotations

from checks import fixtures
from checks.fixtures import SPEND_CHANNEL
from checks.queries import MART_COLUMNS

BOOKINGS = """
bookings AS (
  SELECT event_id, event_type, ts AS booking_datetime,
         ts + to_hours(CAST(event_id % 168 AS INT)) AS event_datetime
  FROM events)"""

CHANNEL_MAP = """
channel_map AS (
  SELECT * FROM (VALUES ('click', 'facebook_ads'), ('purchase', 'tiktok_ads'), ('signup', 'youtube_ads'))
    AS t(event_type, channel_name))"""

SPENDS = f"""
spends AS (
  SELECT DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS date, {SPEND_CHANNEL} AS channel,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
  FROM orders GROUP BY 1, 2)"""

STAFF = """
memberships AS (SELECT l_orderkey AS event_id, l_suppkey AS employee_id FROM lineitem),
employees AS (SELECT s_suppkey AS employee_id, s_name AS employee_name FROM supplier)"""

BASE = """
FROM bookings JOIN channel_map USING (event_type) JOIN spends ON channel_name = channel"""

WITH_BASE = f"WITH {BOOKINGS}, {CHANNEL_MAP}, {SPENDS}"
COST = "ROUND(CAST(SUM(spend) AS DOUBLE) / COUNT(event_id), 0)"

ORACLES: dict[str, str] = {
    "m1_cost_per_lead": f"{WITH_BASE} SELECT channel, {COST} AS cost_per_lead {BASE} GROUP BY 1",
    "m2_daily_leads_by_channel": f"""{WITH_BASE}
        SELECT channel, CAST(booking_datetime AS DATE) AS booking_date, COUNT(event_id) AS n_events {BASE} GROUP BY 1, 2""",
    "m3_channel_leaderboard": f"""{WITH_BASE}
        SELECT channel, CAST(ROUND(SUM(spend), 0) AS DOUBLE) AS spend, COUNT(event_id) AS bookings,
               {COST} AS cost_per_lead {BASE} GROUP BY 1""",
    "m4_bookings_by_day": f"""{WITH_BASE}
        SELECT dayname(booking_datetime) AS booking_day, COUNT(event_id) AS bookings {BASE}
        GROUP BY 1, isodow(booking_datetime)""",
    "m5_bookings_by_hour": f"""{WITH_BASE}
        SELECT hour(booking_datetime) AS booking_hour, COUNT(event_id) AS bookings {BASE} GROUP BY 1""",
    "m6_meetings_by_day": f"""{WITH_BASE}
        SELECT dayname(event_datetime) AS meeting_day, COUNT(event_id) AS bookings {BASE}
        GROUP BY 1, isodow(event_datetime)""",
    "m7_meetings_by_hour": f"""{WITH_BASE}
        SELECT hour(event_datetime) AS event_hour, COUNT(event_id) AS bookings {BASE} GROUP BY 1""",
    "m8_meetings_per_employee_per_day": f"""WITH {BOOKINGS}, {STAFF}
        SELECT employee_name,
               COUNT(DISTINCT event_id) // COUNT(DISTINCT CAST(event_datetime AS DATE)) AS meetings_per_day
        FROM bookings JOIN memberships USING (event_id) JOIN employees USING (employee_id) GROUP BY 1""",
    "x1_true_cost_per_lead": f"""{WITH_BASE},
        leads AS (SELECT channel_name AS channel, COUNT(event_id) AS leads
                  FROM bookings JOIN channel_map USING (event_type) GROUP BY 1),
        spent AS (SELECT channel, SUM(spend) AS spend FROM spends GROUP BY 1)
        SELECT channel, ROUND(CAST(spend AS DOUBLE) / leads, 0) AS cost_per_lead FROM leads JOIN spent USING (channel)""",
    "x2_daily_spend_vs_leads": f"""{WITH_BASE},
        leads AS (SELECT channel_name AS channel, CAST(booking_datetime AS DATE) AS date, COUNT(event_id) AS leads
                  FROM bookings JOIN channel_map USING (event_type) GROUP BY 1, 2)
        SELECT channel, date, COALESCE(CAST(spend AS DOUBLE), 0.0) AS spend, COALESCE(leads, 0) AS leads
        FROM spends FULL JOIN leads USING (channel, date)""",
    "x3_leads_by_day": f"""{WITH_BASE}
        SELECT dayname(booking_datetime) AS booking_day, COUNT(event_id) AS leads
        FROM bookings JOIN channel_map USING (event_type) GROUP BY 1, isodow(booking_datetime)""",
    "x3_leads_by_hour": f"""{WITH_BASE}
        SELECT hour(booking_datetime) AS booking_hour, COUNT(event_id) AS leads
        FROM bookings JOIN channel_map USING (event_type) GROUP BY 1""",
}

# --- documents: what the staging columns must hold, straight from the events ---

REQUESTS = f"""
requests AS (
  SELECT *, CAST(ts AS DATE) AS day,
         CASE WHEN event_id % 97 = 0 THEN 'missing_body'
              WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'error'
              WHEN event_id % 79 = 0 THEN 'skipped'
              WHEN event_type IN ('click', 'purchase', 'signup') THEN 'accepted'
              ELSE 'skipped' END AS outcome,
         CASE WHEN event_id % 97 = 0 THEN 'missing'
              WHEN event_id % 89 = 0 THEN 'malformed'
              WHEN event_id % 83 = 0 THEN 'payload_not_object'
              WHEN event_id % 79 = 0 THEN 'no_payload'
              WHEN {fixtures.NULL_TRACKING} THEN 'tracking_not_object'
              ELSE 'full' END AS document
  FROM events, UNNEST(CASE WHEN {fixtures.COPIES} THEN [0, 1] ELSE [0] END) AS c(copy))"""

_START = "ts + to_hours(CAST(event_id % 168 AS INT))"
_CHANGED = "ts + to_hours(CAST(copy AS INT))"

_VALUES = {
    **fixtures.PAYLOAD_TEXTS,
    "created_at": "ts",
    "updated_at": _CHANGED,
    "new_invitee": "CAST(NULL AS VARCHAR)",
    "old_invitee": "CAST(NULL AS VARCHAR)",
    "no_show": "CAST(NULL AS VARCHAR)",
    "reconfirmation": "CAST(NULL AS VARCHAR)",
    "routing_form_submission": "CAST(NULL AS VARCHAR)",
    "payment": "CASE WHEN event_id % 11 = 0 THEN CAST(event_id AS VARCHAR) END",
    "questions_and_answers": "'0Why?|1When?'",
    "rescheduled": "event_id % 3 = 0",
    **{f"scheduled_event_{name}": sql for name, sql in fixtures.EVENT_TEXTS.items()},
    "scheduled_event_created_at": "ts",
    "scheduled_event_updated_at": _CHANGED,
    "scheduled_event_start_time": _START,
    "scheduled_event_end_time": f"{_START} + INTERVAL 30 MINUTE",
    "scheduled_event_event_guests": """CASE event_id % 4 WHEN 0 THEN 'a@mail.example|b@mail.example'
        WHEN 3 THEN CAST(NULL AS VARCHAR) ELSE '' END""",
    "scheduled_event_event_memberships": """'u' || user_id || '/host' || user_id || '@mail.example/User ' || user_id""",
    **{f"scheduled_event_invitees_counter_{n}": f"CAST({sql} AS BIGINT)" for n, sql in fixtures.COUNTER_INTS.items()},
    **{f"scheduled_event_location_{name}": sql for name, sql in fixtures.LOCATION_TEXTS.items()},
    **{f"tracking_{name}": sql for name, sql in fixtures.TRACKING_TEXTS.items()},
}


def _staged(*names: str) -> str:
    """The given staging columns; a document without a payload leaves them NULL."""
    return ", ".join(f"CASE WHEN document = 'full' THEN {_VALUES[name]} END AS {name}" for name in names)


_ROWS = "FROM requests WHERE document IN ('full', 'no_payload')"
_EVENT_COLUMNS = [name for name in _VALUES if name.startswith("scheduled_event_")]
_TRACKING_COLUMNS = [name for name in _VALUES if name.startswith("tracking_")]
_TIMESTAMPS = ["created_at", "updated_at", *[f"scheduled_event_{n}" for n in ("created_at", "updated_at", "start_time", "end_time")]]

WITH_REQUESTS = f"WITH {REQUESTS}"

# The stored table: accepted documents, the last copy of each.
STORED = f"""
stored AS (
  SELECT * FROM requests WHERE outcome = 'accepted' AND document = 'full'
  QUALIFY copy = MAX(copy) OVER (PARTITION BY event_id))"""
WITH_STORED = f"WITH {REQUESTS}, {STORED}"

# The stored table of a run over every body: rows without an event are one per date.
PER_DATE = """
per_date AS (
  SELECT DISTINCT day, CASE WHEN document = 'full' THEN event_id END AS event_id
  FROM requests WHERE document IN ('full', 'no_payload'))"""

SNAPSHOTS = f"""
{SPENDS},
snapshots AS (
  SELECT 'spend_data_' || CAST(d.day AS VARCHAR) || '.json' AS file, CAST(d.day AS VARCHAR) AS file_date,
         CAST(s.date AS VARCHAR) AS date, s.channel, CAST(s.spend AS DOUBLE) AS spend
  FROM spends s
  JOIN (SELECT DISTINCT date + CAST(k AS INT) AS day FROM spends, range(3) AS r(k)) d
    ON s.date BETWEEN d.day - 2 AND d.day AND d.day <= (SELECT MAX(date) FROM spends))"""
WITH_SNAPSHOTS = f"WITH {SNAPSHOTS}"

_LATEST = "WHERE file = (SELECT MAX(file) FROM snapshots)"
_BOOKINGS_PER_DATE = f"""WITH {REQUESTS}, {PER_DATE}
    SELECT CAST(day AS VARCHAR) AS event_date, COUNT(*) AS bookings FROM per_date GROUP BY 1"""
_LANDED = f"""{WITH_REQUESTS}
    SELECT 'e' || event_id AS event, event_type, {fixtures.EVENT_TEXTS['status']} AS scheduled_event_status
    FROM requests WHERE outcome = 'accepted'"""

_PIPELINE = f"""WITH {REQUESTS}, {STORED}, {CHANNEL_MAP}, {SPENDS},
    bookings AS (SELECT 'e' || event_id AS event_id, event_type, ts AS booking_datetime,
                        {_START} AS event_datetime FROM stored),
    memberships AS (SELECT 'e' || event_id AS event_id, 'u' || user_id AS employee_id FROM stored),
    employees AS (SELECT DISTINCT 'u' || user_id AS employee_id, 'User ' || user_id AS employee_name FROM stored)"""


def _part(name: str, sql: str) -> str:
    return f"WITH {BOOKINGS} SELECT {sql} AS {name}, COUNT(*) AS bookings FROM bookings GROUP BY 1"


ORACLES |= {
    "a1_json_bodies": f"""{WITH_REQUESTS}
        SELECT CASE WHEN document IN ('full', 'tracking_not_object') THEN event_type END AS event_type,
               document IN ('malformed', 'payload_not_object') AS fault, COUNT(*) AS documents
        FROM requests WHERE document <> 'missing' GROUP BY 1, 2""",
    "a2_allowlist": f"""{WITH_REQUESTS}
        SELECT event_id, CAST(copy AS BIGINT) AS copy, event_type FROM requests WHERE outcome = 'accepted'""",
    "a3_outcomes": f"""{WITH_REQUESTS}
        SELECT outcome, CAST(CASE outcome WHEN 'missing_body' THEN 400 WHEN 'error' THEN 500 ELSE 200 END AS BIGINT) AS status_code,
               COUNT(*) AS requests FROM requests GROUP BY 1, 2""",
    "a4_land_readback": _LANDED,
    "a5_index_files": f"{WITH_SNAPSHOTS} SELECT DISTINCT file FROM snapshots",
    "a6_latest_file": f"{WITH_SNAPSHOTS} SELECT MAX(file) AS file FROM snapshots",
    "a7_file_date": f"{WITH_SNAPSHOTS} SELECT DISTINCT file, file_date FROM snapshots",
    "a8_snapshot_records": f"{WITH_SNAPSHOTS} SELECT file, date, channel, spend FROM snapshots",
    "a9_snapshot_filter": f"{WITH_SNAPSHOTS} SELECT file, date, channel, spend FROM snapshots WHERE date = file_date",
    "a10_guarded_files": f"""{WITH_SNAPSHOTS}
        SELECT file, TRUE AS has_date, CAST(NULL AS VARCHAR) AS fault, COUNT(*) FILTER (date = file_date) AS records
        FROM snapshots GROUP BY 1""",
    "a11_spend_readback": f"""{WITH_SNAPSHOTS}
        SELECT CAST(date AS DATE) AS date, channel, spend, CAST(file_date AS DATE) AS file_date
        FROM snapshots {_LATEST} AND date = file_date""",
    "a12_landed_count": f"""{WITH_SNAPSHOTS}
        SELECT CAST(file_date AS DATE) AS file_date, COUNT(*) AS records
        FROM snapshots {_LATEST} AND date = file_date GROUP BY 1""",
    "a13_folder_dates": f"""{WITH_REQUESTS}
        SELECT CAST(day AS VARCHAR) AS event_date, COUNT(*) AS documents FROM requests WHERE document <> 'missing' GROUP BY 1""",
    "a14_suffix_filter": f"""{WITH_REQUESTS}
        SELECT CAST(day AS VARCHAR) AS event_date, COUNT(*) AS documents
        FROM requests WHERE document <> 'missing' AND copy = 0 GROUP BY 1""",
    "a15_parse_valid": f"""{WITH_REQUESTS}
        SELECT CASE WHEN document IN ('full', 'no_payload') THEN 'row' ELSE document END AS result, COUNT(*) AS documents
        FROM requests WHERE document <> 'missing' GROUP BY 1""",
    "a16_empty_batches": f"{WITH_REQUESTS} SELECT DISTINCT CAST(day AS VARCHAR) AS event_date {_ROWS}",
    "a17_daily_run": _BOOKINGS_PER_DATE,
    "a18_partition_readback": f"""{WITH_REQUESTS}
        SELECT {_staged(*_VALUES)}, CAST(day AS VARCHAR) AS event_date {_ROWS}
        QUALIFY row_number() OVER (PARTITION BY day, CASE WHEN document = 'full' THEN event_id END ORDER BY copy DESC) = 1""",
    "a18_append": f"""WITH {REQUESTS}, {PER_DATE}
        SELECT CAST(day AS VARCHAR) AS event_date, 2 * COUNT(*) AS bookings FROM per_date GROUP BY 1""",
    "a19_registered_partitions": f"""{WITH_REQUESTS}
        SELECT DISTINCT 'event_date=' || CAST(day AS VARCHAR) AS partition {_ROWS}""",
    "a20_consume_once": _BOOKINGS_PER_DATE,
    "b1_payload": f"{WITH_REQUESTS} SELECT document = 'full' AS has_event, COUNT(*) AS rows {_ROWS} GROUP BY 1",
    "b2_flatten": f"""{WITH_REQUESTS}
        SELECT CASE WHEN given THEN {_VALUES['event']} END AS payload_event,
               CASE WHEN given AND event_id % 13 = 0 THEN 'x' END AS payload_no_show_uri,
               CASE WHEN given THEN {fixtures.LOCATION_TEXTS['type']} END AS payload_scheduled_event_location_type,
               CASE WHEN given THEN event_id % 5 END AS payload_scheduled_event_invitees_counter_total,
               CASE WHEN document = 'full' THEN {fixtures.TRACKING_TEXTS['utm_source']} END AS payload_tracking_utm_source,
               CASE WHEN given THEN CAST(1 AS BIGINT) END AS memberships
        FROM (SELECT *, document IN ('full', 'tracking_not_object') AS given FROM requests) WHERE document <> 'missing'""",
    "b3_scheduled_event": f"{WITH_REQUESTS} SELECT {_staged(*_EVENT_COLUMNS)} {_ROWS}",
    "b4_tracking": f"{WITH_REQUESTS} SELECT {_staged('event', *_TRACKING_COLUMNS)} {_ROWS}",
    "b5_staging": f"{WITH_REQUESTS} SELECT {_staged(*_VALUES)}, CAST(day AS VARCHAR) AS event_date {_ROWS}",
    "b6_partition_column": f"{WITH_REQUESTS} SELECT CAST(day AS VARCHAR) AS event_date, COUNT(*) AS rows {_ROWS} GROUP BY 1",
    "b7_timestamps": f"{WITH_REQUESTS} SELECT {_staged('event', *_TIMESTAMPS)} {_ROWS}",
    "b8_date": _part("booking_date", "CAST(booking_datetime AS DATE)"),
    "b9_hour": _part("booking_hour", "hour(booking_datetime)"),
    "b10_day_name": _part("booking_day", "dayname(booking_datetime)"),
    "b11_iso_weekday": _part("weekday", "isodow(booking_datetime)"),
    "b12_round": "SELECT o_orderkey, ROUND(o_totalprice, 0) AS whole_price FROM orders",
    "b13_ratio": """SELECT o_orderpriority, ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_orderkey), 4) AS mean_price
        FROM orders GROUP BY o_orderpriority""",
    "b14_whole_ratio": "SELECT l_suppkey, COUNT(l_orderkey) // MAX(l_linenumber) AS per_line FROM lineitem GROUP BY l_suppkey",
    "b15_landed_names": f"""{WITH_REQUESTS}
        SELECT COUNT(*) AS names, COUNT(*) AS well_formed FROM requests WHERE outcome = 'accepted'""",
    "b16_json_round_trip": f"""WITH {SPENDS}
        SELECT CAST(date AS VARCHAR) AS date, channel, CAST(spend AS DOUBLE) AS spend FROM spends""",
    "c1_channel_join": f"""WITH {BOOKINGS}, {CHANNEL_MAP}
        SELECT event_id, event_type, channel_name FROM bookings JOIN channel_map USING (event_type)""",
    "c2_spend_fanout": f"""{WITH_BASE}
        SELECT channel, COUNT(event_id) AS pairs, CAST(SUM(spend) AS DOUBLE) AS spend {BASE} GROUP BY 1""",
    "c3_memberships_join": f"""WITH {BOOKINGS}, {STAFF}
        SELECT DISTINCT event_id, employee_name, CAST(event_datetime AS DATE) AS day
        FROM bookings JOIN memberships USING (event_id) JOIN employees USING (employee_id)""",
    "c4_employees_join": f"""WITH {STAFF}
        SELECT DISTINCT event_id, employee_name FROM memberships JOIN employees USING (employee_id)""",
    "c5_semi_join": f"""WITH {BOOKINGS}, {CHANNEL_MAP}
        SELECT event_id, event_type FROM bookings WHERE event_type IN (SELECT event_type FROM channel_map)""",
    "d1_sum_spend": f"""WITH {SPENDS}
        SELECT channel, CAST(SUM(spend) AS DOUBLE) AS spend, COUNT(*) AS spend_rows FROM spends GROUP BY 1""",
    "d2_count_events": f"""{WITH_REQUESTS}
        SELECT CASE WHEN document = 'full' THEN event_type END AS event_type,
               COUNT(CASE WHEN document = 'full' THEN event_id END) AS events, COUNT(*) AS bookings {_ROWS} GROUP BY 1""",
    "d3_two_distincts": f"""WITH {BOOKINGS}, {STAFF}
        SELECT employee_name, COUNT(DISTINCT event_id) AS events, COUNT(DISTINCT CAST(event_datetime AS DATE)) AS days
        FROM bookings JOIN memberships USING (event_id) JOIN employees USING (employee_id) GROUP BY 1""",
    "d6_dedup": f"""{WITH_STORED}
        SELECT CAST(day AS VARCHAR) AS event_date, {_staged('event', 'status', 'updated_at')} FROM stored""",
    "d6_null_keys": f"""{WITH_REQUESTS}
        SELECT CAST(day AS VARCHAR) AS event_date, COUNT(DISTINCT day) AS rows
        FROM requests WHERE document = 'no_payload' GROUP BY 1""",
    "v1_bookings": f"""{WITH_STORED}
        SELECT 'e' || event_id AS event_id, event_type, ts AS booking_datetime, {_START} AS event_datetime FROM stored""",
    "v2_channel_map": f"""WITH {BOOKINGS}, {CHANNEL_MAP}
        SELECT event_type, COUNT(event_id) AS bookings, ANY_VALUE(channel_name) AS channel_name
        FROM bookings LEFT JOIN channel_map USING (event_type) GROUP BY 1""",
    "v3_spends": f"WITH {SPENDS} SELECT date, channel, CAST(spend AS DOUBLE) AS spend FROM spends",
    "v4_memberships": f"{WITH_STORED} SELECT 'e' || event_id AS event_id, 'u' || user_id AS employee_id FROM stored",
    "v5_employees": f"""{WITH_STORED}
        SELECT DISTINCT 'u' || user_id AS employee_id, 'User ' || user_id AS employee_name FROM stored""",
    "m3_from_documents": f"""{_PIPELINE}
        SELECT channel, CAST(ROUND(SUM(spend), 0) AS DOUBLE) AS spend, COUNT(event_id) AS bookings,
               {COST} AS cost_per_lead {BASE} GROUP BY 1""",
    "m8_from_documents": f"""{_PIPELINE}
        SELECT employee_name,
               COUNT(DISTINCT event_id) // COUNT(DISTINCT CAST(event_datetime AS DATE)) AS meetings_per_day
        FROM bookings JOIN memberships USING (event_id) JOIN employees USING (employee_id) GROUP BY 1""",
    "x4_quarantine": f"""{WITH_REQUESTS}
        SELECT document AS reason, COUNT(*) AS documents FROM requests
        WHERE document NOT IN ('missing', 'full', 'no_payload') GROUP BY 1""",
    "x5_rebuild_across_runs": f"""{WITH_REQUESTS}
        SELECT {_staged(*_VALUES)}, CAST(day AS VARCHAR) AS event_date {_ROWS}
        QUALIFY row_number() OVER (PARTITION BY day, CASE WHEN document = 'full' THEN event_id END ORDER BY copy DESC) = 1""",
}

# Undeclared leaves: what a document has of each. Its writer leaves out null members of structs.
_LEAVES = {
    "event": "TRUE",
    **{f"payload_{name}": f"({sql}) IS NOT NULL" for name, sql in fixtures.PAYLOAD_TEXTS.items()},
    **{f"payload_{name}": "TRUE" for name in ("created_at", "updated_at", "rescheduled", "questions_and_answers")},
    "payload_no_show_uri": "event_id % 13 = 0",
    "payload_payment": "event_id % 11 = 0",
    "payload_tracking": fixtures.NULL_TRACKING,
    # As a VARIANT the tracking part keeps its null members.
    **{f"payload_tracking_{name}": f"NOT {fixtures.NULL_TRACKING}" for name in fixtures.TRACKING_TEXTS},
    **{f"payload_scheduled_event_{name}": f"({sql}) IS NOT NULL" for name, sql in fixtures.EVENT_TEXTS.items()},
    **{f"payload_scheduled_event_{name}": "TRUE" for name in ("created_at", "updated_at", "start_time", "end_time", "event_memberships")},
    "payload_scheduled_event_event_guests": "event_id % 4 <> 2",
    **{f"payload_scheduled_event_invitees_counter_{name}": "TRUE" for name in fixtures.COUNTER_INTS},
    **{f"payload_scheduled_event_location_{n}": f"({sql}) IS NOT NULL" for n, sql in fixtures.LOCATION_TEXTS.items()},
}
ORACLES["b2_undeclared_leaves"] = f"""{WITH_REQUESTS}, leaves AS (
        {" UNION ALL ".join(f"SELECT '{name}' AS leaf FROM requests WHERE document IN ('full', 'tracking_not_object') AND {there}" for name, there in _LEAVES.items())}
        UNION ALL SELECT 'payload' FROM requests WHERE document = 'payload_not_object'
        UNION ALL SELECT 'other' FROM requests WHERE document = 'no_payload')
        SELECT leaf, COUNT(*) AS documents FROM leaves GROUP BY 1"""

ORACLES["a9_catch_up"] = f"""WITH {SPENDS}
        SELECT date, channel, CAST(spend AS DOUBLE) AS spend, date AS file_date FROM spends"""
ORACLES["a14_new_files"] = f"""{WITH_REQUESTS}
        SELECT CAST(day AS VARCHAR) AS event_date, COUNT(*) AS documents
        FROM requests WHERE document <> 'missing' AND copy = 1 GROUP BY 1"""
ORACLES["a20_repeated_batch"] = ORACLES["a20_consume_once"]
ORACLES["m3_from_states"] = ORACLES["m3_from_documents"]
ORACLES["m8_from_states"] = ORACLES["m8_from_documents"]
ORACLES["x5_bucketed_merge"] = ORACLES["x5_rebuild_across_runs"]
ORACLES["a3_outcomes_by_table"] = ORACLES["a3_outcomes"]
ORACLES["a4_stream_landing"] = ORACLES["a4_land_readback"]

_MARTS = [name for name in ORACLES if name[0] == "m" and name[1].isdigit() and not name.endswith(("_from_documents", "_from_states"))]


def _mart_values(query: str) -> str:
    mart = query.split("_", 1)[1]
    labels, numbers = MART_COLUMNS[mart]
    label = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in labels)
    values = [f"CAST({c} AS DOUBLE)" for c in numbers] + ["CAST(NULL AS DOUBLE)"] * (3 - len(numbers))
    listed = ", ".join(f"{v} AS value{i}" for i, v in enumerate(values))
    return f"SELECT '{mart}' AS mart, {label} AS label, {listed} FROM ({ORACLES[query]})"


ORACLES["m9_refresh"] = " UNION ALL ".join(_mart_values(name) for name in _MARTS)
