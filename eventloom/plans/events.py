"""Event volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions import month_floor, safe_divide


def distinct(column: str, approx: bool = False, rsd: float = 0.01) -> Column:
    """Number of distinct values; ``approx`` trades exactness for a sketch that is merged on the map side."""
    return F.approx_count_distinct(column, rsd) if approx else F.countDistinct(column)


def event_overview(events: DataFrame, approx: bool = False) -> DataFrame:
    """Events, users, active days and events per day of each event name, in one scan.

    Only distinct (name, user) and (name, day) pairs travel. ``approx`` replaces them by sketches of fixed size.
    """
    return (
        events.groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            distinct("user_pseudo_id", approx).alias("unique_users"),
            distinct("event_date", approx).alias("unique_days"),
        )
        .withColumn("events_per_day", F.round(safe_divide(F.col("total_events"), F.col("unique_days")), 1))
        .orderBy(F.desc("total_events"), "event_name")
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Number of events per name, most frequent first."""
    return events.groupBy("event_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_name")


def event_users(events: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users per event name."""
    return events.groupBy("event_name").agg(distinct("user_pseudo_id", approx).alias("users"))


def top_events(events: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent event names with their users."""
    return (
        events.groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_pseudo_id").alias("users"))
        .orderBy(F.desc("events"), "event_name")
        .limit(n)
    )


def daily_events(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(F.count(F.lit(1)).alias("daily_events")).orderBy("event_date")


def event_date_users(events: DataFrame, names: Sequence[str] = ("purchase", "add_to_cart", "view_item")) -> DataFrame:
    """Distinct users per day and event, for some events."""
    return (
        events.where(F.col("event_name").isin(*names))
        .groupBy("event_date", "event_name")
        .agg(F.countDistinct("user_pseudo_id").alias("users"))
        .orderBy("event_date", "event_name")
    )


def monthly_event_summary(events: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Events and users per month and event name, optionally for some names only."""
    if names is not None:
        events = events.where(F.col("event_name").isin(*names))
    return (
        events.groupBy(month_floor(F.col("event_date")).alias("month"), "event_name")
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_pseudo_id").alias("users"))
        .orderBy("month", "event_name")
    )


def pivot_events(events: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per day and one column per event name (names are given, so no extra pass finds them)."""
    counts = [F.count_if(F.col("event_name") == name).alias(name) for name in names]
    return events.groupBy("event_date").agg(*counts).orderBy("event_date")
