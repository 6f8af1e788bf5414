"""The eight marts, and their un-fanned companions, over the curated tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmill.functions.calendar import day_name, hour_of_day, iso_weekday
from callmill.functions.ratios import mean_cost, whole, whole_ratio
from callmill.operators.fanout import channel_totals, count_bookings, hourly_counts, pair_totals, sum_hours

BOOKED = "booking_datetime"
MEETING = "event_datetime"


@dataclass(frozen=True)
class Curated:
    """The five curated tables; what is already counted of them; the spends of the period, if it is not all time."""

    bookings: DataFrame
    channel_map: DataFrame
    spends: DataFrame
    memberships: DataFrame
    employees: DataFrame
    hourly: DataFrame | None = None
    totals: DataFrame | None = None
    period_spends: DataFrame | None = None


def _totals(curated: Curated) -> DataFrame:
    return channel_totals(curated.spends) if curated.totals is None else curated.totals


def _period_spends(curated: Curated) -> DataFrame:
    return curated.spends if curated.period_spends is None else curated.period_spends


def bookings_per_hour(curated: Curated) -> DataFrame:
    return hourly_counts(curated.bookings, [BOOKED, MEETING])


def _counts(curated: Curated, keys: Mapping[str, Column], ts: str = BOOKED) -> DataFrame:
    if curated.hourly is None:
        return count_bookings(curated.bookings, keys)
    return sum_hours(curated.hourly, ts, keys)


def _paired(curated: Curated, keys: Mapping[str, Column], by_channel: bool, ts: str = BOOKED) -> DataFrame:
    return pair_totals(
        _counts(curated, keys, ts),
        curated.channel_map,
        _totals(curated),
        (["channel"] if by_channel else []) + list(keys),
    )


def _cost_per_lead() -> Column:
    return whole(mean_cost(F.col("paired_spend"), F.col("paired_ids")))


def cost_per_lead(curated: Curated) -> DataFrame:
    return (
        _paired(curated, {}, by_channel=True)
        .select("channel", _cost_per_lead().alias("cost_per_lead"))
        .orderBy(F.col("cost_per_lead").asc_nulls_last())
    )


def daily_leads_by_channel(curated: Curated) -> DataFrame:
    return (
        _paired(curated, {"booking_date": F.to_date(BOOKED)}, by_channel=True)
        .select("channel", "booking_date", F.col("paired_ids").alias("n_events"))
        .orderBy(F.col("channel").asc_nulls_last(), F.col("booking_date").asc_nulls_last())
    )


def channel_leaderboard(curated: Curated) -> DataFrame:
    return (
        _paired(curated, {}, by_channel=True)
        .select(
            "channel",
            whole(F.col("paired_spend")).cast("double").alias("spend"),
            F.col("paired_ids").alias("bookings"),
            _cost_per_lead().alias("cost_per_lead"),
        )
        .orderBy(F.col("spend").asc_nulls_last())
    )


def _by_weekday(curated: Curated, ts: str, label: str) -> DataFrame:
    keys = {label: day_name(F.col(ts)), "weekday": iso_weekday(F.col(ts))}
    return (
        _paired(curated, keys, by_channel=False, ts=ts)
        .orderBy(F.col("weekday").asc_nulls_last())
        .select(label, F.col("paired_ids").alias("bookings"))
    )


def _by_hour(curated: Curated, ts: str, label: str) -> DataFrame:
    return (
        _paired(curated, {label: hour_of_day(F.col(ts))}, by_channel=False, ts=ts)
        .select(label, F.col("paired_ids").alias("bookings"))
        .orderBy(F.col(label).asc_nulls_last())
    )


def bookings_by_day(curated: Curated) -> DataFrame:
    return _by_weekday(curated, BOOKED, "booking_day")


def bookings_by_hour(curated: Curated) -> DataFrame:
    return _by_hour(curated, BOOKED, "booking_hour")


def meetings_by_day(curated: Curated) -> DataFrame:
    return _by_weekday(curated, MEETING, "meeting_day")


def meetings_by_hour(curated: Curated) -> DataFrame:
    return _by_hour(curated, MEETING, "event_hour")


def staffed(curated: Curated) -> DataFrame:
    """Each event with each name of its members, once."""
    return curated.memberships.join(curated.employees, "employee_id").select("event_id", "employee_name").distinct()


def staffed_days(curated: Curated) -> DataFrame:
    """Each event's names with each of its meeting days; ``first_day`` is 1 on one day of an event.

    Copies are dropped on both sides before the join (partial aggregates do most
    of it ahead of the shuffle), so a hot event costs its days times its employees
    and not its copies squared.
    """
    days = (
        curated.bookings.where(F.col("event_id").isNotNull())
        .select("event_id", F.to_date(MEETING).alias("day"))
        .distinct()
    )
    first = F.row_number().over(Window.partitionBy("event_id").orderBy("day")) == 1
    days = days.select("event_id", "day", first.cast("int").alias("first_day"))
    return staffed(curated).join(days, "event_id")


def employee_activity(curated: Curated) -> DataFrame:
    """Distinct events and distinct meeting days per employee name.

    Summing the marks counts events without a distinct over the joined rows, which then
    shrink to one row per name and day before they move again.
    """
    per_day = staffed_days(curated).groupBy("employee_name", "day").agg(F.sum("first_day").alias("events"))
    return per_day.groupBy("employee_name").agg(F.sum("events").alias("events"), F.count("day").alias("days"))


def meetings_per_employee_per_day(curated: Curated) -> DataFrame:
    """Days without meetings do not count."""
    return (
        employee_activity(curated)
        .select("employee_name", whole_ratio(F.col("events"), F.col("days")).alias("meetings_per_day"))
        .orderBy(F.col("meetings_per_day").desc_nulls_last())
    )


MARTS = {
    "cost_per_lead": cost_per_lead,
    "daily_leads_by_channel": daily_leads_by_channel,
    "channel_leaderboard": channel_leaderboard,
    "bookings_by_day": bookings_by_day,
    "bookings_by_hour": bookings_by_hour,
    "meetings_by_day": meetings_by_day,
    "meetings_by_hour": meetings_by_hour,
    "meetings_per_employee_per_day": meetings_per_employee_per_day,
}


# Companions without the fan-out: each booking counts once, each spend row once.


def _leads(curated: Curated, keys: Mapping[str, Column]) -> DataFrame:
    counts = _counts(curated, keys).join(curated.channel_map, "event_type")
    return counts.groupBy(F.col("channel_name").alias("channel"), *keys).agg(F.sum("ids").alias("leads"))


def true_cost_per_lead(curated: Curated) -> DataFrame:
    return (
        _leads(curated, {})
        .join(channel_totals(_period_spends(curated)), "channel")
        .select("channel", whole(mean_cost(F.col("channel_spend"), F.col("leads"))).alias("cost_per_lead"))
        .orderBy(F.col("cost_per_lead").asc_nulls_last())
    )


def daily_spend_vs_leads(curated: Curated) -> DataFrame:
    leads = _leads(curated, {"date": F.to_date(BOOKED)})
    spent = _period_spends(curated).groupBy("channel", "date").agg(F.sum("spend").alias("spend"))
    return (
        spent.join(leads, ["channel", "date"], "full_outer")
        .select(
            "channel",
            "date",
            F.coalesce(F.col("spend").cast("double"), F.lit(0.0)).alias("spend"),
            F.coalesce("leads", F.lit(0)).cast("bigint").alias("leads"),
        )
        .orderBy(F.col("channel").asc_nulls_last(), F.col("date").asc_nulls_last())
    )


def leads_by_day(curated: Curated) -> DataFrame:
    ts = F.col(BOOKED)
    return (
        _leads(curated, {"booking_day": day_name(ts), "weekday": iso_weekday(ts)})
        .groupBy("booking_day", "weekday")
        .agg(F.sum("leads").alias("leads"))
        .orderBy(F.col("weekday").asc_nulls_last())
        .select("booking_day", "leads")
    )


def leads_by_hour(curated: Curated) -> DataFrame:
    return (
        _leads(curated, {"booking_hour": hour_of_day(F.col(BOOKED))})
        .groupBy("booking_hour")
        .agg(F.sum("leads").alias("leads"))
        .orderBy(F.col("booking_hour").asc_nulls_last())
    )
