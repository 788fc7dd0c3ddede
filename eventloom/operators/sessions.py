"""Sessions: one per user and day, or separated by a gap of inactivity.

Gap sessions are found without ever sorting the events of a user in one task. Time is cut into slots as long as the
gap. Two events of a user in the same slot are closer together than the gap, so they belong to the same session and a
slot collapses into one summary row by ordinary partial aggregation. Only these summaries are put in order per user;
their number is bounded by the covered time divided by the gap, however many events a user has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GAP_MINUTES = 30


def _slot(micros: Column, gap_micros: int) -> Column:
    gap = F.lit(gap_micros).cast("long")
    return micros - F.pmod(micros, gap)


def _numbered_slots(slots: DataFrame, user: str, gap_micros: int) -> DataFrame:
    """Add ``session_number`` to slot summaries holding ``first_us`` and ``last_us``."""
    ordered = Window.partitionBy(user).orderBy("slot")
    previous = F.lag("last_us").over(ordered)
    starts = F.when(previous.isNull() | (F.col("first_us") - previous > gap_micros), 1).otherwise(0)
    return slots.withColumn("starts", starts.cast("long")).withColumn(
        "session_number", F.sum("starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("starts")


def _slots(
    events: DataFrame, user: str, micros: str, gap_micros: int, extra: Sequence[Column], per_user: Sequence[str] = ()
) -> DataFrame:
    return (
        events.where(F.col(user).isNotNull() & F.col(micros).isNotNull())
        .withColumn("slot", _slot(F.col(micros), gap_micros))
        .groupBy(user, *per_user, "slot")
        .agg(F.min(micros).alias("first_us"), F.max(micros).alias("last_us"), F.count(F.lit(1)).alias("n"), *extra)
    )


def session_activity(
    events: DataFrame,
    user: str = "user_pseudo_id",
    micros: str = "event_timestamp",
    keep_first: Sequence[str] = (),
    order_by: Sequence[str] = (),
    gap_minutes: int = GAP_MINUTES,
    per_user: Sequence[str] = (),
) -> DataFrame:
    """One row per gap session: number, first and last microsecond, number of events.

    ``keep_first`` columns take their value from the first event of the session, by time and then ``order_by``.
    ``per_user`` columns have one value per user and cost nothing; the first event is a minimum over a struct, which
    Spark finds by sorting the events of each map task. Raw events are never shuffled: they are reduced to slot
    summaries on the map side first.
    """
    gap_micros = gap_minutes * 60_000_000
    rank = F.struct(F.col(micros), *[F.col(c) for c in order_by])
    first_event = [F.min(F.struct(rank.alias("rank"), *[F.col(c) for c in keep_first])).alias("first_event")]
    slots = _slots(events, user, micros, gap_micros, first_event if keep_first else [], per_user)
    numbered = _numbered_slots(slots, user, gap_micros)
    first = [F.min("first_event").alias("first_event")] if keep_first else []
    sessions = numbered.groupBy(user, *per_user, "session_number").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n").alias("events"), *first
    )
    return sessions.select(
        user, *per_user, "session_number", "first_us", "last_us", "events", *[F.col(f"first_event.{c}") for c in keep_first]
    )


def number_sessions(
    events: DataFrame,
    user: str = "user_pseudo_id",
    micros: str = "event_timestamp",
    gap_minutes: int = GAP_MINUTES,
) -> DataFrame:
    """Every event with the ``session_number`` of its user (NULL without user or time).

    The join back is on user and slot; AQE splits a slot that holds too many events of one user.
    """
    gap_micros = gap_minutes * 60_000_000
    numbered = _numbered_slots(_slots(events, user, micros, gap_micros, []), user, gap_micros)
    slotted = events.withColumn("slot", _slot(F.col(micros), gap_micros))
    return slotted.join(numbered.select(user, "slot", "session_number"), [user, "slot"], "left").drop("slot")


def user_day_sessions(
    events: DataFrame,
    attributes: Sequence[str] = ("device_category", "traffic_source_medium"),
    keys: Sequence[str] = ("user_pseudo_id", "event_date"),
    order_by: Sequence[str] = ("event_timestamp",),
) -> DataFrame:
    """Session table: one row per ``keys``, with the attributes of the earliest event.

    Give the session id instead of the date in ``keys`` when events carry one. The earliest event is found by a
    minimum over a struct, an aggregate that combines on the map side. Attributes come after ``order_by`` in that
    struct, so equal order keys still give one definite row.
    """
    earliest = F.min(F.struct(*[F.col(c) for c in (*order_by, *attributes)])).alias("earliest")
    return events.groupBy(*keys).agg(earliest).select(*keys, *[F.col(f"earliest.{a}") for a in attributes])
