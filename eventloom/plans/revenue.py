"""Revenue over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.operators.rolling import rolling_mean_days, rolling_mean_rows

REVENUE = "ecommerce_purchase_revenue_in_usd"


def purchases(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") == "purchase")


def daily_revenue(events: DataFrame) -> DataFrame:
    """Transactions, revenue and average order value per day."""
    return (
        purchases(events)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(REVENUE).alias("revenue"), F.avg(REVENUE).alias("avg_order_value"))
        .orderBy("event_date")
    )


def daily_revenue_7day(events: DataFrame, calendar: bool = False) -> DataFrame:
    """Daily revenue with buyers and the mean over seven rows (or seven calendar days)."""
    daily = (
        purchases(events)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum(REVENUE).alias("revenue"),
            F.avg(REVENUE).alias("aov"),
            F.countDistinct("user_pseudo_id").alias("unique_buyers"),
        )
    )
    rolling = rolling_mean_days if calendar else rolling_mean_rows
    return rolling(daily, "event_date", "revenue", "revenue_7day").orderBy("event_date")


def purchase_by_day(events: DataFrame) -> DataFrame:
    """Revenue and number of purchases per day."""
    return purchases(events).groupBy("event_date").agg(F.sum(REVENUE).alias("revenue"), F.count(F.lit(1)).alias("n"))


def revenue_date_device(events: DataFrame) -> DataFrame:
    """Buyers and revenue per day and device."""
    return (
        purchases(events)
        .groupBy("event_date", "device_category")
        .agg(F.countDistinct("user_pseudo_id").alias("users"), F.sum(REVENUE).alias("revenue"))
        .orderBy("event_date", F.desc("revenue"), F.asc_nulls_last("device_category"))
    )
