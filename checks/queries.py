"""Registered queries: each takes (spark, sf_dir) and reads the given tables.

Queries about files write what they need below the session's shared folder, each to
a new path, and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures
from callmill.functions import calendar, ratios
from callmill.operators import intake, staging
from callmill.operators.dedup import latest_bookings
from callmill.operators.fanout import channel_totals, count_bookings, pair_totals
from callmill.operators.flatten import flatten, flatten_documents, leaf_names
from callmill.plans import curated, daily, landing, marts, refresh, states
from callmill.schemas import STAGED
from callmill.session import scratch
from callmill.sources import documents, files, ledger, snapshots, tables, versions
from callmill.streaming.daily import daily_stream
from callmill.streaming.intake import land_stream

Query = Callable[[SparkSession, str], DataFrame]

ALLOWED = fixtures.ALLOWED_EVENT_TYPES


def _mart(build: Callable[[marts.Curated], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fixtures.curated(spark, sf_dir))


def _count(rows: DataFrame, *keys: str | Column, name: str = "documents") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _plain(name: str, type_: T.DataType) -> Column:
    """A staged column as a flat value: local timestamps, lists as joined text."""
    column = F.col(name)
    if isinstance(type_, T.TimestampType):
        column = column.cast("timestamp_ntz")
    elif isinstance(type_, T.IntegerType):
        column = column.cast("bigint")
    elif name == "questions_and_answers":
        column = F.array_join(F.transform(column, lambda q: F.concat(q["position"].cast("string"), q["question"])), "|")
    elif name == "scheduled_event_event_memberships":
        column = F.array_join(F.transform(column, lambda m: F.concat_ws("/", m["user"], m["user_email"], m["user_name"])), "|")
    elif isinstance(type_, T.ArrayType):
        column = F.array_join(column, "|")
    return column.alias(name)


def _plain_columns(prefix: str = "") -> list[Column]:
    return [_plain(name, type_) for name, (type_, _) in STAGED.items() if name.startswith(prefix)]


def _with_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.documents(spark, sf_dir).where(F.col("body").isNotNull())


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.accepted(intake.classify(fixtures.documents(spark, sf_dir), ALLOWED))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged_rows(staging.stage_documents(_with_body(spark, sf_dir)))


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table of the accepted documents, in memory."""
    return latest_bookings(staging.staged_rows(staging.stage_documents(_accepted(spark, sf_dir))))


def _stores(spark: SparkSession, label: str, table: str | None = None) -> daily.Stores:
    root = scratch(spark, label)
    return daily.Stores(f"{root}/raw", f"{root}/staging", f"{root}/quarantine", f"{root}/work", table)


def _arrive(rows: DataFrame, root: str, date: str = "event_date") -> None:
    """Land documents as if they had arrived on their own date, many to a compressed file."""
    dated = rows.select(F.col(date).alias(documents.ARRIVAL), documents.one_line(F.col("body")).alias("value"))
    dealt = dated.hint("rebalance", documents.ARRIVAL)
    # The fastest level: a better one takes more time than the bytes that it saves are worth.
    packed = dealt.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.partitionBy(documents.ARRIVAL).text(root)


def _ran(spark: SparkSession, sf_dir: str, label: str, mode: str = daily.REBUILD) -> daily.Stores:
    stores = _stores(spark, label)
    _arrive(_with_body(spark, sf_dir), stores.raw)
    daily.run_daily(spark, stores, documents.GZIPPED, mode)
    return stores


def _snapshot_root(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Snapshot files as JSON arrays in one folder each, and an index of their names."""
    root = scratch(spark, label)
    rows = fixtures.spend_days(spark, sf_dir)
    record = F.struct("date", "channel", "spend")
    rows.groupBy("file").agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("file").text(
        f"{root}/snapshots"
    )
    rows.agg(F.sort_array(F.collect_set("file")).alias("files")).write.json(f"{root}/index")
    return root


# --- sources and sinks ---


def a1_json_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, "a1")
    _arrive(_with_body(spark, sf_dir), stores.raw)
    read = intake.read_event_types(documents.bodies(spark, stores.raw, documents.GZIPPED))
    return _count(read, "event_type", "fault")


def a2_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("event_id", F.col("copy").cast("bigint").alias("copy"), "event_type")


def a3_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.outcome_counts(intake.classify(fixtures.documents(spark, sf_dir), ALLOWED))


def a3_outcomes_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = intake.classify(fixtures.documents(spark, sf_dir), fixtures.channels(spark))
    return intake.outcome_counts(classified)


def _landed(spark: SparkSession, root: str) -> DataFrame:
    staged = staging.stage_documents(documents.raw_documents(spark, root, documents.LINES))
    return staged.select("event", F.col("scheduled_event_event_type").alias("event_type"), "scheduled_event_status")


def a4_land_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "a4")
    landing.intake(fixtures.documents(spark, sf_dir), ALLOWED, root)
    return _landed(spark, root)


def a4_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "a4-stream")
    _arrive(_with_body(spark, sf_dir), f"{root}/requests")
    land_stream(
        spark, f"{root}/requests", f"{root}/raw", f"{root}/checkpoint", ALLOWED, documents.GZIPPED
    ).awaitTermination()
    return _landed(spark, f"{root}/raw")


def a5_index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.index_files(spark, f"{_snapshot_root(spark, sf_dir, 'a5')}/index")


def a6_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.latest_file(fixtures.spend_days(spark, sf_dir)).select("file")


def a7_file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fixtures.spend_days(spark, sf_dir).select("file").distinct()
    return names.select("file", files.file_date(F.col("file")).alias("file_date"))


def _records(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return snapshots.read_snapshots(spark, f"{_snapshot_root(spark, sf_dir, label)}/snapshots")


def a8_snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "a8").select("file", "date", "channel", "spend")


def a9_snapshot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = snapshots.of_date(_records(spark, sf_dir, "a9"), files.file_date(F.col("file")))
    return own.select("file", "date", "channel", "spend")


def _land_missing(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Every date landed in one load, each from the latest of the files that show it."""
    root = _snapshot_root(spark, sf_dir, label)
    read = snapshots.read_snapshots(spark, f"{root}/snapshots")
    snapshots.require_all_sound(snapshots.guards(snapshots.index_files(spark, f"{root}/index"), read))
    snapshots.land_dates(snapshots.latest_of_dates(read), f"{root}/landed")
    return f"{root}/landed"


def a9_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = tables.read_spends(spark, _land_missing(spark, sf_dir, "a9-catch-up"))
    return landed.withColumn("spend", F.col("spend").cast("double"))


def a10_guarded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load's guards find in each listed file."""
    root = _snapshot_root(spark, sf_dir, "a10")
    read = snapshots.read_snapshots(spark, f"{root}/snapshots")
    guarded = snapshots.guards(snapshots.index_files(spark, f"{root}/index"), read)
    return guarded.select("file", (F.col("file_date") != "").alias("has_date"), "fault", "records")


def _land_latest(spark: SparkSession, sf_dir: str, label: str) -> str:
    root = _snapshot_root(spark, sf_dir, label)
    listed = snapshots.index_files(spark, f"{root}/index")
    file, date = snapshots.require_latest(listed)
    read = snapshots.read_snapshots(spark, f"{root}/snapshots/file={file}").withColumn("file", F.lit(file))
    snapshots.require_sound(snapshots.guards(listed.where(F.col("file") == file), read))
    for _ in range(2):  # the second run replaces the first one's folder
        snapshots.land_records(snapshots.of_date(read, F.lit(date)), date, f"{root}/landed")
    return f"{root}/landed"


def a11_spend_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _land_latest(spark, sf_dir, "a11")
    return tables.read_spends(spark, landed).withColumn("spend", F.col("spend").cast("double"))


def a12_landed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(tables.read_spends(spark, _land_latest(spark, sf_dir, "a12")), "file_date", name="records")


def a13_folder_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, "a13")
    _arrive(_with_body(spark, sf_dir), stores.raw)
    return _count(documents.raw_documents(spark, stores.raw, documents.GZIPPED), "event_date")


def a14_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first copies land as .json, the others as .txt.gz; only .json is read."""
    stores = _stores(spark, "a14")
    rows = _with_body(spark, sf_dir)
    _arrive(rows.where("copy = 1"), stores.raw)
    named = rows.where("copy = 0").select(F.col("event_date").alias(documents.ARRIVAL), "event_id")
    named.write.mode("append").partitionBy(documents.ARRIVAL).json(stores.raw)
    json_lines = documents.Layout(documents.FILES.suffix, per_file=False)
    return _count(documents.raw_documents(spark, stores.raw, json_lines), "event_date")


def a14_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second copies arrive when the first have been taken: the documents that a second run reads."""
    stores = _stores(spark, "a14-new")
    rows = _with_body(spark, sf_dir)
    _arrive(rows.where("copy = 0"), stores.raw)
    daily.run_daily(spark, stores, documents.GZIPPED)
    _arrive(rows.where("copy = 1"), stores.raw)
    state = versions.current(spark, stores.staging)
    found = ledger.compare(spark, stores.staging, state.ledger, stores.raw, documents.GZIPPED)
    return _count(documents.pending_documents(spark, stores.raw, documents.GZIPPED, found.fresh), "event_date")


def a15_parse_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging.stage_documents(_with_body(spark, sf_dir))
    return _count(staged, F.coalesce("reason", F.lit("row")).alias("result"))


def a16_empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All unreadable bodies arrive in a folder of their own, which gets no partition."""
    stores = _stores(spark, "a16")
    rows = _with_body(spark, sf_dir).withColumn(
        "arrived", F.when(F.col("body") == "not json", "unreadable").otherwise(F.col("event_date"))
    )
    _arrive(rows, stores.raw, "arrived")
    daily.run_daily(spark, stores, documents.GZIPPED)
    return tables.read_staging(spark, stores.staging).select("event_date").distinct()


def a17_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _ran(spark, sf_dir, "a17")
    return _count(tables.read_staging(spark, stores.staging), "event_date", name="bookings")


def a18_partition_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _ran(spark, sf_dir, "a18")
    return tables.read_staging(spark, stores.staging).select(*_plain_columns(), "event_date")


def a18_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a second run over the same files adds its rows again."""
    stores = _ran(spark, sf_dir, "a18-append", daily.APPEND)
    daily.run_daily(spark, stores, documents.GZIPPED, daily.APPEND)
    return _count(tables.read_staging(spark, stores.staging), "event_date", name="bookings")


def a19_registered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "a19")
    table = f"events_{root[-32:]}"
    stores = daily.Stores(f"{root}/raw", f"{root}/staging", f"{root}/quarantine", f"{root}/work", table)
    _arrive(_with_body(spark, sf_dir), stores.raw)
    daily.run_daily(spark, stores, documents.GZIPPED)
    tables.register_all(spark, table)  # finds nothing new
    return spark.sql(f"SHOW PARTITIONS {table}")


def a20_consume_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stream runs in append mode: the second finds no file left to take."""
    stores = _stores(spark, "a20")
    _arrive(_with_body(spark, sf_dir), stores.raw)
    for _ in range(2):
        daily_stream(spark, stores, f"{stores.work}-checkpoint", documents.GZIPPED, daily.APPEND).awaitTermination()
    return _count(tables.read_staging(spark, stores.staging), "event_date", name="bookings")


def a20_repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a batch that comes again after its rows were published adds nothing."""
    stores = _stores(spark, "a20-repeated")
    _arrive(_with_body(spark, sf_dir), stores.raw)
    rows = documents.raw_documents(spark, stores.raw, documents.GZIPPED)
    for _ in range(2):
        daily.ingest(spark, rows, stores, "stream-0", daily.APPEND)
    return _count(tables.read_staging(spark, stores.staging), "event_date", name="bookings")


# --- flattening and scalar functions ---


def b1_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(_staged(spark, sf_dir), F.col("event").isNotNull().alias("has_event"), name="rows")


# The parts of a document that are flattened; given, so that the texts are read once.
FLATTENED = """payload struct<event: string, no_show: struct<uri: string>, tracking: struct<utm_source: string>,
    scheduled_event: struct<location: struct<type: string>, invitees_counter: struct<total: bigint>,
        event_memberships: array<struct<user: string>>>>"""


def b2_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, "b2")
    _arrive(_with_body(spark, sf_dir), stores.raw)
    flat = flatten(spark.read.schema(FLATTENED).json(stores.raw, pathGlobFilter="*.txt.gz", recursiveFileLookup=True))
    return flat.select(
        "payload_event",
        "payload_no_show_uri",
        "payload_scheduled_event_location_type",
        "payload_scheduled_event_invitees_counter_total",
        "payload_tracking_utm_source",
        F.size("payload_scheduled_event_event_memberships").cast("bigint").alias("memberships"),
    )


def b3_scheduled_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).select(*_plain_columns("scheduled_event_"))


def b4_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).select("event", *_plain_columns("tracking_"))


def b5_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).select(*_plain_columns(), "event_date")


def b6_partition_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(_staged(spark, sf_dir), "event_date", name="rows")


def b7_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = [_plain(name, type_) for name, (type_, _) in STAGED.items() if isinstance(type_, T.TimestampType)]
    return _staged(spark, sf_dir).select("event", *stamps)


def _booking_part(name: str, part: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fixtures.bookings(spark, sf_dir)
        return _count(rows, part(F.col("booking_datetime")).alias(name), name="bookings")

    return query


def b12_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", ratios.whole(F.col("o_totalprice")).alias("whole_price")
    )


def b13_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "orders").groupBy("o_orderpriority")
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    return rows.agg(F.round(ratios.mean_cost(price, F.count("o_orderkey")), 4).alias("mean_price"))


def b14_whole_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return rows.agg(ratios.whole_ratio(F.count("l_orderkey"), F.max("l_linenumber").cast("bigint")).alias("per_line"))


def b15_landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _accepted(spark, sf_dir).select(calendar.landed_name().alias("name"))
    shape = r"^\d{4}-\d{2}-\d{2}/\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}_[0-9a-f-]{36}\.json$"
    return names.agg(F.countDistinct("name").alias("names"), F.count_if(F.col("name").rlike(shape)).alias("well_formed"))


def b16_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.spends(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    text = rows.select(F.to_json(F.struct("date", "channel", "spend")).alias("line"))
    return text.select(F.from_json("line", "date string, channel string, spend double").alias("r")).select("r.*")


# --- joins, aggregates, dedup ---


def c1_channel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.curated(spark, sf_dir)
    return c.bookings.join(c.channel_map, "event_type").select("event_id", "event_type", "channel_name")


def c2_spend_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.curated(spark, sf_dir)
    paired = pair_totals(count_bookings(c.bookings, {}), c.channel_map, channel_totals(c.spends), ["channel"])
    return paired.select("channel", F.col("paired_ids").alias("pairs"), F.col("paired_spend").cast("double").alias("spend"))


def c3_memberships_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their members' names and their meeting days, as the employee mart counts them."""
    return marts.staffed_days(fixtures.curated(spark, sf_dir)).select("event_id", "employee_name", "day")


def c4_employees_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.staffed(fixtures.curated(spark, sf_dir))


def c5_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.curated(spark, sf_dir)
    return intake.keep_allowed(c.bookings, c.channel_map).select("event_id", "event_type")


def d1_sum_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = channel_totals(fixtures.spends(spark, sf_dir))
    return totals.select("channel", F.col("channel_spend").cast("double").alias("spend"), "spend_rows")


def d2_count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an event do not count."""
    counts = count_bookings(curated.bookings(_staged(spark, sf_dir)), {})
    return counts.select("event_type", F.col("ids").alias("events"), F.col("rows").alias("bookings"))


def d3_two_distincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.employee_activity(fixtures.curated(spark, sf_dir))


def d6_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staging(spark, sf_dir).select(
        "event_date", "event", "status", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")
    )


def d6_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an event collapse to one per date."""
    rows = latest_bookings(_staged(spark, sf_dir)).where(F.col("event").isNull())
    return _count(rows, "event_date", name="rows")


# --- curated tables and the whole pipeline ---


def v1_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.bookings(_staging(spark, sf_dir)).select(
        "event_id",
        "event_type",
        F.col("booking_datetime").cast("timestamp_ntz").alias("booking_datetime"),
        F.col("event_datetime").cast("timestamp_ntz").alias("event_datetime"),
    )


def v2_channel_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension against the event types met in the bookings."""
    met = fixtures.bookings(spark, sf_dir).groupBy("event_type").agg(F.count("event_id").alias("bookings"))
    return met.join(fixtures.channels(spark), "event_type", "left")


def v3_spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "v3")
    rows = fixtures.spends(spark, sf_dir).withColumn("file_date", F.col("date"))
    rows.write.partitionBy("file_date").json(root)
    landed = curated.spends(tables.read_spends(spark, root))
    return landed.withColumn("spend", F.col("spend").cast("double"))


def v4_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.memberships(_staging(spark, sf_dir))


def v5_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.employees(_staging(spark, sf_dir))


def _from_states(spark: SparkSession, sf_dir: str, label: str) -> marts.Curated:
    """The same from per-date results: first of all originals, then renewed for the dates of the canceled copies."""
    stores = _stores(spark, label)
    landed = _land_missing(spark, sf_dir, f"{label}-spends")
    rows = _accepted(spark, sf_dir)
    for copy in (0, 1):
        _arrive(rows.where(F.col("copy") == copy), stores.raw)
        daily.run_daily(spark, stores, documents.GZIPPED)
        found = states.renew(spark, stores.staging, landed, f"{stores.work}-states")
    return states.curate(spark, found, fixtures.channels(spark))


def _pipeline(spark: SparkSession, sf_dir: str, label: str) -> marts.Curated:
    """Intake, landing, the daily job, then the curated tables of what it stored."""
    stores = _stores(spark, label)
    _arrive(_accepted(spark, sf_dir), stores.raw)
    daily.run_daily(spark, stores, documents.GZIPPED)
    stored = tables.read_staging(spark, stores.staging)
    return curated.curate(stored, fixtures.channels(spark), fixtures.spends(spark, sf_dir))


def m3_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.channel_leaderboard(_pipeline(spark, sf_dir, "m3"))


def m8_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.meetings_per_employee_per_day(_pipeline(spark, sf_dir, "m8"))


def m3_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.channel_leaderboard(_from_states(spark, sf_dir, "m3-states"))


def m8_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.meetings_per_employee_per_day(_from_states(spark, sf_dir, "m8-states"))


# Columns of each mart: those that name a row, and its numbers.
MART_COLUMNS = {
    "cost_per_lead": (["channel"], ["cost_per_lead"]),
    "daily_leads_by_channel": (["channel", "booking_date"], ["n_events"]),
    "channel_leaderboard": (["channel"], ["spend", "bookings", "cost_per_lead"]),
    "bookings_by_day": (["booking_day"], ["bookings"]),
    "bookings_by_hour": (["booking_hour"], ["bookings"]),
    "meetings_by_day": (["meeting_day"], ["bookings"]),
    "meetings_by_hour": (["event_hour"], ["bookings"]),
    "meetings_per_employee_per_day": (["employee_name"], ["meetings_per_day"]),
}


def m9_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of the refreshed marts, read back; a second refresh the same day does nothing."""
    root = scratch(spark, "m9")
    tables_ = fixtures.curated(spark, sf_dir)
    refresh.refresh(spark, tables_, root)
    refresh.refresh(spark, tables_, root)
    found = []
    for name, (labels, numbers) in MART_COLUMNS.items():
        texts = [F.col(c).cast("string") for c in labels]
        values = [F.col(c).cast("double") for c in numbers] + [F.lit(None).cast("double")] * (3 - len(numbers))
        found.append(
            refresh.read_mart(spark, root, name).select(
                F.lit(name).alias("mart"),
                F.concat_ws("|", *texts).alias("label"),
                *[v.alias(f"value{i}") for i, v in enumerate(values)],
            )
        )
    return reduce(DataFrame.unionByName, found)


def x4_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refusals after two runs over the same files."""
    stores = _ran(spark, sf_dir, "x4")
    daily.run_daily(spark, stores, documents.GZIPPED)
    return daily.quarantine_reasons(daily.read_quarantine(spark, stores))


def b2_undeclared_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves of all documents by name, without a word about their keys."""
    return leaf_names(flatten_documents(_with_body(spark, sf_dir).select("event_id", "copy", "body")))


def x5_bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dates of many buckets, of which the second run rewrites some."""
    return _rebuilt(spark, sf_dir, replace(_stores(spark, "x5-buckets"), bucket_rows=100))


def x5_rebuild_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canceled copies arrive after a run; the next run lets them replace their originals."""
    return _rebuilt(spark, sf_dir, _stores(spark, "x5"))


def _rebuilt(spark: SparkSession, sf_dir: str, stores: daily.Stores) -> DataFrame:
    rows = _with_body(spark, sf_dir)
    for copy in (0, 1):
        _arrive(rows.where(F.col("copy") == copy), stores.raw)
        daily.run_daily(spark, stores, documents.GZIPPED)
    return tables.read_staging(spark, stores.staging).select(*_plain_columns(), "event_date")


QUERIES: dict[str, Query] = {
    "m1_cost_per_lead": _mart(marts.cost_per_lead),
    "m2_daily_leads_by_channel": _mart(marts.daily_leads_by_channel),
    "m3_channel_leaderboard": _mart(marts.channel_leaderboard),
    "m4_bookings_by_day": _mart(marts.bookings_by_day),
    "m5_bookings_by_hour": _mart(marts.bookings_by_hour),
    "m6_meetings_by_day": _mart(marts.meetings_by_day),
    "m7_meetings_by_hour": _mart(marts.meetings_by_hour),
    "m8_meetings_per_employee_per_day": _mart(marts.meetings_per_employee_per_day),
    "x1_true_cost_per_lead": _mart(marts.true_cost_per_lead),
    "x2_daily_spend_vs_leads": _mart(marts.daily_spend_vs_leads),
    "x3_leads_by_day": _mart(marts.leads_by_day),
    "x3_leads_by_hour": _mart(marts.leads_by_hour),
    "b8_date": _booking_part("booking_date", F.to_date),
    "b9_hour": _booking_part("booking_hour", calendar.hour_of_day),
    "b10_day_name": _booking_part("booking_day", calendar.day_name),
    "b11_iso_weekday": _booking_part("weekday", lambda ts: calendar.iso_weekday(ts).cast("bigint")),
} | {
    query.__name__: query
    for query in (
        *(a1_json_bodies, a2_allowlist, a3_outcomes, a3_outcomes_by_table, a4_land_readback, a4_stream_landing),
        *(a5_index_files, a6_latest_file, a7_file_date, a8_snapshot_records, a9_snapshot_filter, a10_guarded_files),
        *(a11_spend_readback, a12_landed_count, a13_folder_dates, a14_suffix_filter, a15_parse_valid),
        *(a16_empty_batches, a17_daily_run, a18_partition_readback, a18_append, a19_registered_partitions),
        *(a9_catch_up, a14_new_files, a20_repeated_batch, b2_undeclared_leaves, x5_bucketed_merge),
        *(m3_from_states, m8_from_states),
        *(a20_consume_once, b1_payload, b2_flatten, b3_scheduled_event, b4_tracking, b5_staging),
        *(b6_partition_column, b7_timestamps, b12_round, b13_ratio, b14_whole_ratio, b15_landed_names),
        *(b16_json_round_trip, c1_channel_join, c2_spend_fanout, c3_memberships_join, c4_employees_join),
        *(c5_semi_join, d1_sum_spend, d2_count_events, d3_two_distincts, d6_dedup, d6_null_keys),
        *(v1_bookings, v2_channel_map, v3_spends, v4_memberships, v5_employees),
        *(m3_from_documents, m8_from_documents, m9_refresh, x4_quarantine, x5_rebuild_across_runs),
    )
}
