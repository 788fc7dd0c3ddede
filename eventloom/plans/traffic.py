"""Traffic sources, devices and conversion.

Sessions and events are reduced to one row per user (and day) before they are joined, with the number of rows they
stand for. The join then sees few rows per key, whatever the number of events of one user, and the fan-out of the
original row-by-row join is kept by multiplying the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions import channel_group, safe_divide
from eventloom.operators.ranking import share_of_total


def purchasers(events: DataFrame) -> DataFrame:
    """Distinct users with a purchase."""
    return events.where(F.col("event_name") == "purchase").select("user_pseudo_id").distinct()


def device_medium_purchases(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users and purchases per device and medium, joined on user and day."""
    keys = ["user_pseudo_id", "event_date"]
    per_day = events.groupBy(*keys).agg(F.count_if(F.col("event_name") == "purchase").alias("purchases"))
    per_session = sessions.groupBy(*keys, "device_category", "traffic_source_medium").agg(
        F.count(F.lit(1)).alias("n_sessions")
    )
    return (
        per_session.join(per_day, keys)
        .groupBy("device_category", "traffic_source_medium")
        .agg(
            F.countDistinct("user_pseudo_id").alias("users"),
            F.sum(F.col("purchases") * F.col("n_sessions")).alias("purchases"),
        )
        .orderBy(F.desc("users"), F.asc_nulls_last("device_category"), F.asc_nulls_last("traffic_source_medium"))
    )


def _sessions_with_purchase(sessions: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Sessions per user and ``keys`` with the flag ``purchased``."""
    buyers = purchasers(events).withColumn("purchased", F.lit(True))
    per_user = sessions.groupBy("user_pseudo_id", *keys).agg(F.count(F.lit(1)).alias("n_sessions"))
    return per_user.join(buyers, "user_pseudo_id", "left").withColumn(
        "purchased", F.coalesce("purchased", F.lit(False))
    )


def device_conversion(sessions: DataFrame, events: DataFrame, distinct_users: bool = False) -> DataFrame:
    """Conversion per device and medium.

    Purchasers are counted in session rows, so the rate may exceed one; ``distinct_users`` counts each buyer once.
    """
    keys = ["device_category", "traffic_source_medium"]
    buyers = F.lit(1) if distinct_users else F.col("n_sessions")
    return (
        _sessions_with_purchase(sessions, events, keys)
        .groupBy(*keys)
        .agg(F.count("user_pseudo_id").alias("users"), F.sum(F.when(F.col("purchased"), buyers).otherwise(0)).alias("purchasers"))
        .withColumn("cvr", safe_divide(F.col("purchasers"), F.col("users")))
        .orderBy(F.desc("cvr"), *[F.asc_nulls_last(k) for k in keys])
    )


def traffic_channels(sessions: DataFrame, events: DataFrame, distinct_users: bool = False) -> DataFrame:
    """Sessions, users, buyers, conversion and share of sessions per marketing channel."""
    grouped = sessions.withColumn("channel", channel_group(F.col("traffic_source_medium")))
    buyers = F.lit(1) if distinct_users else F.col("n_sessions")
    channels = (
        _sessions_with_purchase(grouped, events, ["channel"])
        .groupBy("channel")
        .agg(
            F.sum("n_sessions").alias("sessions"),
            F.count("user_pseudo_id").alias("unique_users"),
            F.sum(F.when(F.col("purchased"), buyers).otherwise(0)).alias("converters"),
        )
        .withColumn("cvr", safe_divide(F.col("converters"), F.col("unique_users")))
    )
    return share_of_total(channels, "sessions", "sessions_pct").orderBy(F.desc("sessions"), "channel")
