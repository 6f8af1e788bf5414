"""Curated tables from the staging table and the landed spends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.plans.marts import Curated


def within(rows: DataFrame, start: str | None = None, end: str | None = None, date: str = "event_date") -> DataFrame:
    """Only the dates from ``start`` to ``end``, both included; prunes partitions."""
    if start is not None:
        rows = rows.where(F.col(date) >= start)
    if end is not None:
        rows = rows.where(F.col(date) <= end)
    return rows


def bookings(staging: DataFrame, *also: str) -> DataFrame:
    return staging.select(
        *also,
        F.col("event").alias("event_id"),
        F.col("scheduled_event_event_type").alias("event_type"),
        F.col("created_at").alias("booking_datetime"),
        F.col("scheduled_event_start_time").alias("event_datetime"),
    )


def channel_map(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """The event type to channel dimension, from the deployment's settings."""
    rows = [F.struct(F.lit(t).alias("event_type"), F.lit(c).alias("channel_name")) for t, c in pairs]
    return spark.range(1).select(F.inline(F.array(*rows)))


def spends(landed: DataFrame) -> DataFrame:
    return landed.select("date", "channel", "spend")


def memberships(staging: DataFrame, *also: str) -> DataFrame:
    """One row per event and member; events without members drop."""
    member = F.explode("scheduled_event_event_memberships")
    return staging.select(*also, F.col("event").alias("event_id"), member.alias("member")).select(
        *also, "event_id", F.col("member.user").alias("employee_id")
    )


def spellings(staging: DataFrame, *also: str) -> DataFrame:
    """Each name of each member, and when it was last given."""
    members = staging.select(
        *also,
        F.col("scheduled_event_updated_at").alias("seen"),
        F.explode("scheduled_event_event_memberships").alias("member"),
    )
    spelled = [F.col("member.user").alias("employee_id"), F.col("member.user_name").alias("employee_name")]
    return members.where(F.col("member.user").isNotNull()).groupBy(*also, *spelled).agg(F.max("seen").alias("seen"))


def employees(staging: DataFrame) -> DataFrame:
    """One name per member: the latest one given, the larger text on a tie.

    Grouping by id and name first leaves one row per spelling, so a member with a
    third of all events is small before it is ranked.
    """
    return latest_names(spellings(staging))


def latest_names(spelled: DataFrame) -> DataFrame:
    # A missing name or time ranks below any given one.
    rank = F.struct(F.col("employee_name").isNotNull().alias("named"), F.col("seen"), F.col("employee_name"))
    return spelled.groupBy("employee_id").agg(F.max_by("employee_name", rank).alias("employee_name"))


def curate(
    staging: DataFrame, channels: DataFrame, landed_spends: DataFrame, start: str | None = None, end: str | None = None
) -> Curated:
    """The curated tables, bookings from ``start`` to ``end``.

    The eight marts pair bookings with all spends; the companions, which set a day's spends against its
    leads, get the spends of the same days.
    """
    staging = within(staging, start, end)
    spent = spends(landed_spends)
    return Curated(
        bookings=bookings(staging),
        channel_map=channels,
        spends=spent,
        memberships=memberships(staging),
        employees=employees(staging),
        period_spends=within(spent, start, end, "date") if start or end else None,
    )
