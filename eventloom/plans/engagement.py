"""Session length and bounces, from gap sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventloom.operators.quantiles import exact_quantiles
from eventloom.operators.ranking import top_per_group
from eventloom.workspace import stage


def with_duration(sessions: DataFrame) -> DataFrame:
    """Add the length of a session in seconds."""
    return sessions.withColumn("duration_s", (F.col("last_us") - F.col("first_us")) / F.lit(1e6))


def p99_session_duration(sessions: DataFrame, by: str = "device_category") -> DataFrame:
    """Number of sessions and the 99th percentile of their length per device."""
    lengths = stage(with_duration(sessions).select(by, "duration_s"), "session-lengths")
    counts = lengths.groupBy(by).agg(F.count(F.lit(1)).alias("sessions"))
    p99 = exact_quantiles(lengths, "duration_s", {"p99_duration_s": 0.99}, by=[by])
    same = counts[by].eqNullSafe(p99[by])
    return counts.join(p99, same).select(counts[by], "sessions", "p99_duration_s")


def bounce_rate(sessions: DataFrame, page: str = "page_path") -> DataFrame:
    """Sessions, bounces (a single event) and bounce rate per landing page."""
    return (
        sessions.groupBy(page)
        .agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("events") == 1).alias("bounces"))
        .withColumn("bounce_rate", F.try_divide(F.col("bounces").cast("double"), F.col("sessions").cast("double")))
        .orderBy(F.desc("sessions"), page)
    )


def longest_sessions(sessions: DataFrame, by: str = "device_category", n: int = 3) -> DataFrame:
    """The ``n`` longest sessions of each device, with their rank."""
    order = [F.desc("duration_s"), F.col("user_pseudo_id"), F.col("session_number")]
    return top_per_group(with_duration(sessions), [by], order, n)


def return_times(sessions: DataFrame, by: str = "device_category") -> DataFrame:
    """Mean pause between two sessions of a user, per device.

    The window holds the sessions of one user, at most the covered time divided by the session gap.
    """
    previous = F.lag("last_us").over(Window.partitionBy("user_pseudo_id").orderBy("session_number"))
    pause = sessions.withColumn("pause_s", (F.col("first_us") - previous) / F.lit(1e6))
    return pause.groupBy(by).agg(F.count("pause_s").alias("returns"), F.avg("pause_s").alias("mean_pause_s"))
