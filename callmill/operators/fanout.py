"""Sums and counts over a join that pairs every booking with every spend row.

The marts join bookings to spends on the channel alone, so a channel with E
bookings and D spend rows yields E x D pairs. Only sums and counts of those pairs
are ever used, and these factor: each side is aggregated first and the join
sees one row per group. No pair is built, and no channel is too hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Which of the two times of a booking an hourly count is by.
COUNTED_BY = "counted_by"


def _by(keys: Mapping[str, Column]) -> list:
    return ["event_type", *[column.alias(name) for name, column in keys.items()]]


def count_bookings(bookings: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Rows and non-null ids per event type and key, before any join.

    The partial aggregate shrinks each input split to one row per group, so one
    event type that holds most bookings costs no more than the others.
    """
    return bookings.groupBy(*_by(keys)).agg(
        F.count("event_id").alias("ids"),
        F.count(F.lit(1)).alias("rows"),
    )


def hourly_counts(bookings: DataFrame, times: Sequence[str], *also: str) -> DataFrame:
    """The counts above per event type and hour, and further columns, once by each time, in one scan.

    Every day, weekday and hour key can be taken from the hour again, so all marts
    of a refresh share this small table in place of the bookings.
    """
    truncated = [F.date_trunc("hour", time).alias(time) for time in times]
    hours = bookings.select(*also, "event_type", "event_id", *truncated)
    sets = [[*also, "event_type", time] for time in times]
    counted_by = F.when(F.grouping(times[0]) == 0, times[0])
    for time in times[1:]:
        counted_by = counted_by.when(F.grouping(time) == 0, time)
    return hours.groupingSets(sets, *also, "event_type", *times).agg(
        F.count("event_id").alias("ids"), F.count(F.lit(1)).alias("rows"), counted_by.alias(COUNTED_BY)
    )


def sum_hours(hourly: DataFrame, time: str, keys: Mapping[str, Column]) -> DataFrame:
    """``count_bookings`` from hourly counts."""
    return (
        hourly.where(F.col(COUNTED_BY) == time)
        .groupBy(*_by(keys))
        .agg(F.sum("ids").alias("ids"), F.sum("rows").alias("rows"))
    )


def channel_totals(spends: DataFrame, *also: str) -> DataFrame:
    """One row per channel (and further columns): summed spend and number of spend rows."""
    return spends.groupBy(*also, "channel").agg(
        F.sum("spend").alias("channel_spend"),
        F.count(F.lit(1)).alias("spend_rows"),
    )


def pair_totals(counts: DataFrame, channel_map: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` + paired_spend (decimal) and paired_ids (bigint).

    Equal to grouping the pairs themselves: every booking row brings its channel's
    spend once, and every booking id is counted once per spend row.
    """
    paired = counts.join(channel_map, "event_type").join(totals, F.col("channel_name") == F.col("channel"))
    return paired.groupBy(*keys).agg(
        F.sum(F.col("rows") * F.col("channel_spend")).alias("paired_spend"),
        F.sum(F.col("ids") * F.col("spend_rows")).alias("paired_ids"),
    )
