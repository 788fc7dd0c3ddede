"""New and returning users."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions import safe_divide, user_type
from eventloom.plans.revenue import REVENUE, purchases

SESSION_KEY = "ga_session_number"


def session_types(params: DataFrame) -> DataFrame:
    """Distinct session numbers per user and user type; session numbers that are no number give a NULL type."""
    return (
        params.where(F.col("key") == SESSION_KEY)
        .withColumn("user_type", user_type(F.col("param_value")))
        .groupBy("user_pseudo_id", "user_type")
        .agg(F.countDistinct("param_value").alias("sessions"))
    )


def user_segments(params: DataFrame, events: DataFrame) -> DataFrame:
    """Users, buyers, revenue and sessions per user type.

    A user seen as new and as returning counts in both, with the full revenue in both.
    """
    spending = (
        purchases(events)
        .groupBy("user_pseudo_id")
        .agg(F.count(F.lit(1)).alias("purchases"), F.sum(REVENUE).alias("revenue"))
    )
    return (
        session_types(params)
        .join(spending, "user_pseudo_id", "left")
        .withColumn("purchased", F.col("purchases").isNotNull())
        .fillna({"purchases": 0, "revenue": 0.0})
        .groupBy("user_type")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.count_if("purchased").alias("buyers"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("revenue").alias("avg_revenue"),
            F.sum("sessions").alias("total_sessions"),
            F.avg("sessions").alias("avg_sessions"),
        )
        .withColumn("cvr", safe_divide(F.col("buyers"), F.col("total_users")))
    )
