"""Fan-out, dedup, flatten, ratios and ordering on small tables."""

import dataclasses
import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from callmill.functions import calendar, ratios
from callmill.operators import flatten as flatten_step
from callmill.operators.dedup import best_per_key
from callmill.operators.flatten import flatten
from callmill.plans import curated, marts

BOOKING = "event_id string, event_type string, booking_datetime timestamp_ntz, event_datetime timestamp_ntz"


def random_tables(spark, seed):
    """NULL ids, types, times and spends; a type of two channels; channels of one side only."""
    rng = random.Random(seed)

    def moment():
        return rng.choice([None, datetime.datetime(2024, 1, rng.randint(1, 9), rng.randint(0, 23))])

    bookings = [
        (rng.choice([None, f"e{rng.randint(0, 9)}"]), rng.choice([None, "a", "b", "c", "d", "x"]), moment(), moment())
        for _ in range(60)
    ]
    channels = [("a", "A"), ("b", "B"), ("c", "A"), ("c", "B"), ("d", "only_booked"), ("e", "only_mapped")]
    spends = [
        (
            datetime.date(2024, 1, rng.randint(1, 9)),
            rng.choice([None, "A", "B", "only_spent"]),
            rng.choice([None, Decimal(rng.randint(-999, 9999)) / 100]),
        )
        for _ in range(25)
    ]
    members = [(f"e{rng.randint(0, 12)}", rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(40)]
    names = [(1, "Ann"), (2, "Bob"), (3, "Ann"), (4, None), (2, "Bobby"), (9, "Nobody")]
    return marts.Curated(
        bookings=spark.createDataFrame(bookings, BOOKING),
        channel_map=curated.channel_map(spark, channels),
        spends=spark.createDataFrame(spends, "date date, channel string, spend decimal(18,2)"),
        memberships=spark.createDataFrame(members, "event_id string, employee_id int"),
        employees=spark.createDataFrame(names, "employee_id int, employee_name string"),
    )


def naive(tables, keys, by_channel):
    """The marts' join as written: every booking with every spend row of its channel."""
    pairs = tables.bookings.join(tables.channel_map, "event_type").join(
        tables.spends, F.col("channel_name") == F.col("channel")
    )
    columns = [F.expr(sql).alias(name) for name, sql in keys.items()]
    return pairs.groupBy(*(["channel"] if by_channel else []), *columns).agg(
        F.round(F.sum("spend"), 0).cast("double").alias("spend"),
        F.count("event_id").alias("n"),
        F.expr("round(try_divide(cast(sum(spend) as double), count(event_id)), 0)").alias("cost"),
    )


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_factored_marts_equal_the_naive_join(spark, seed):
    t = random_tables(spark, seed)
    whole = naive(t, {}, True)
    assert rows_of(marts.cost_per_lead(t)) == rows_of(whole.select("channel", "cost"))
    assert rows_of(marts.channel_leaderboard(t)) == rows_of(whole.select("channel", "spend", "n", "cost"))
    daily = naive(t, {"d": "to_date(booking_datetime)"}, True)
    assert rows_of(marts.daily_leads_by_channel(t)) == rows_of(daily.select("channel", "d", "n"))
    for build, ts in ((marts.bookings_by_day, "booking_datetime"), (marts.meetings_by_day, "event_datetime")):
        by_day = naive(t, {"name": f"date_format({ts}, 'EEEE')", "dow": f"weekday({ts}) + 1"}, False)
        assert rows_of(build(t)) == rows_of(by_day.select("name", "n"))
    for build, ts in ((marts.bookings_by_hour, "booking_datetime"), (marts.meetings_by_hour, "event_datetime")):
        by_hour = naive(t, {"hour": f"cast(hour({ts}) as bigint)"}, False)
        assert rows_of(build(t)) == rows_of(by_hour.select("hour", "n"))


@pytest.mark.parametrize("seed", range(2))
def test_marts_from_hourly_counts(spark, seed):
    t = random_tables(spark, seed)
    hourly = dataclasses.replace(t, bookings=None, hourly=marts.bookings_per_hour(t))
    for name, build in marts.MARTS.items():
        if name != "meetings_per_employee_per_day":
            assert rows_of(build(hourly)) == rows_of(build(t)), name


@pytest.mark.parametrize("seed", range(4))
def test_employee_activity_equals_two_distincts(spark, seed):
    t = random_tables(spark, seed)
    joined = t.bookings.join(t.memberships, "event_id").join(t.employees, "employee_id").groupBy("employee_name")
    day = F.to_date("event_datetime")
    expected = joined.agg(F.countDistinct("event_id").alias("events"), F.countDistinct(day).alias("days"))
    assert rows_of(marts.employee_activity(t)) == rows_of(expected)
    ratio = expected.selectExpr("employee_name", "events div nullif(days, 0)")
    assert rows_of(marts.meetings_per_employee_per_day(t)) == rows_of(ratio)


def test_cost_per_lead_is_the_mean_spend_row(spark):
    """The fan-out makes the mart independent of the bookings; kept on purpose."""
    t = random_tables(spark, 7)
    mean = t.spends.groupBy("channel").agg(F.expr("cast(sum(spend) as double) / count(1)").alias("mean"))
    ids = t.bookings.where("event_id IS NOT NULL")
    with_ids = marts.Curated(ids, t.channel_map, t.spends, t.memberships, t.employees)
    found = marts.cost_per_lead(with_ids).join(mean, "channel").collect()
    assert found and all(row.cost_per_lead == float(int(row["mean"] + 0.5)) for row in found)


def test_order(spark):
    t = random_tables(spark, 1)
    week = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", None]
    for build in (marts.bookings_by_day, marts.meetings_by_day):
        names = [row[0] for row in build(t).collect()]
        assert names == [day for day in week if day in names] and None in names
    hours = [row[0] for row in marts.bookings_by_hour(t).collect()]
    assert hours[-1] is None and hours[:-1] == sorted(hours[:-1])
    channels = [row[0] for row in marts.daily_leads_by_channel(t).collect()]
    assert channels == sorted(channels)
    costs = [row[1] for row in marts.cost_per_lead(t).collect()]
    assert costs == sorted(costs)
    spends = [row[1] for row in marts.channel_leaderboard(t).collect()]
    assert spends == sorted(spends)
    rates = [row[1] for row in marts.meetings_per_employee_per_day(t).collect()]
    given = [rate for rate in rates if rate is not None]
    assert rates == sorted(given, reverse=True) + [None] * (len(rates) - len(given))


def test_daily_spend_vs_leads_keeps_both_sides(spark):
    t = marts.Curated(
        bookings=spark.createDataFrame([("e1", "a", datetime.datetime(2024, 1, 1), None)], BOOKING),
        channel_map=curated.channel_map(spark, [("a", "A")]),
        spends=spark.createDataFrame([(datetime.date(2024, 1, 2), "A", Decimal("5.00"))], "date date, channel string, spend decimal(18,2)"),
        memberships=None,
        employees=None,
    )
    found = [tuple(row) for row in marts.daily_spend_vs_leads(t).collect()]
    assert found == [("A", datetime.date(2024, 1, 1), 0.0, 1), ("A", datetime.date(2024, 1, 2), 5.0, 0)]


def test_ratios(spark):
    df = spark.createDataFrame([(7, 2, 2.5), (-7, 2, -2.5), (7, 0, 0.4)], "a bigint, b bigint, c double")
    found = df.select(
        ratios.whole_ratio(F.col("a"), F.col("b")),
        ratios.mean_cost(F.col("a").cast("decimal(18,2)"), F.col("b")),
        ratios.whole(F.col("c")),
    ).collect()
    assert [tuple(row) for row in found] == [(3, 3.5, 3.0), (-3, -3.5, -3.0), (None, None, 0.0)]


def test_calendar(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 7, 23, 59),), (datetime.datetime(2024, 1, 8),)], "t timestamp_ntz")
    t = F.col("t")
    found = df.select(calendar.day_name(t), calendar.iso_weekday(t), calendar.hour_of_day(t)).collect()
    assert [tuple(row) for row in found] == [("Sunday", 7, 23), ("Monday", 1, 0)]


def test_best_per_key_does_not_depend_on_order(spark):
    rows = [
        ("d", "k", 1, "a", ["x"]),
        ("d", "k", 2, "b", None),
        ("d", "k", 2, "b", ["z"]),
        ("d", "k", None, "z", ["z"]),
        ("d", None, 1, "a", None),
        ("d", None, 3, "a", None),
        ("e", "k", 1, "a", None),
    ]
    schema = "day string, event string, at int, uri string, more array<string>"
    results = set()
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame(shuffled, schema).repartition(3)
        results.add(str(rows_of(best_per_key(df, ["day", "event"], ["at"]))))
    assert results == {str(sorted([rows[2], rows[5], rows[6]], key=repr))}


def test_best_per_key_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS key", "id AS at")
    plan = best_per_key(df, ["key"], ["at"])._jdf.queryExecution().executedPlan().toString()
    partial, shuffled = plan.index("Partial"), plan.index("Exchange")
    assert shuffled < partial  # printed top-down: the partial limit lies below the exchange


def test_flatten(spark):
    df = spark.read.json(
        spark.sparkContext.parallelize(
            ['{"a":1,"b":{"c":{"d":"x"},"e":[{"f":1}],"g":null},"b_c_d":"own","h.i":{"j`k":2}}']
        )
    )
    flat = flatten(df)
    # The last of two equal names wins and keeps the first one's place.
    assert flat.columns == ["a", "b_c_d", "b_e", "b_g", "h.i_j`k"]
    row = flat.first()
    assert (row["a"], row["b_c_d"], row["b_e"][0]["f"], row["b_g"], row["h.i_j`k"]) == (1, "own", 1, None, 2)
    assert flatten(df, sep=".").columns == ["a", "b.c.d", "b.e", "b.g", "b_c_d", "h.i.j`k"]


def test_flatten_reads_only_the_leaves_used(spark, tmp_path):
    spark.range(3).selectExpr("named_struct('a', id, 'b', named_struct('c', id, 'd', id)) s").write.parquet(str(tmp_path / "t"))
    plan = flatten(spark.read.parquet(str(tmp_path / "t"))).select("s_b_c")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:struct<b:struct<c:bigint>>>" in plan


def test_employees_take_the_latest_name(spark):
    member = "array<struct<user:string,user_email:string,user_name:string>>"
    rows = [
        ("2024-01-01", [("u1", None, "Old"), ("u2", None, "Only")]),
        ("2024-01-03", [("u1", None, "New"), ("u3", None, None)]),
        ("2024-01-04", [("u1", None, None), (None, None, "Ghost")]),
        (None, [("u1", None, "Undated")]),
        ("2024-01-05", None),
        ("2024-01-05", []),
    ]
    df = spark.createDataFrame(rows, f"at string, scheduled_event_event_memberships {member}").withColumn(
        "scheduled_event_updated_at", F.to_timestamp("at")
    )
    assert rows_of(curated.employees(df)) == [("u1", "New"), ("u2", "Only"), ("u3", None)]
    members = curated.memberships(df.withColumn("event", F.lit("e")))
    assert members.count() == 7


def test_opened_objects_are_not_written_twice(spark):
    """An object goes on to the next level as its text; its JSON besides would be written for nothing."""
    raw = '{"b":1,"a":{"x":"y"},"b":2,"c":[{"z":1}]}'
    opened = spark.createDataFrame([(7, "p", [3], raw)], "row bigint, leaf string, at array<int>, raw string")
    found = flatten_step._opened(opened, "_").orderBy("leaf").collect()
    assert [tuple(row) for row in found] == [
        (7, "p_a", [3, 1], None, '{"x":"y"}'),
        (7, "p_b", [3, 0], "2", None),
        (7, "p_c", [3, 3], '[{"z":1}]', None),
    ]
