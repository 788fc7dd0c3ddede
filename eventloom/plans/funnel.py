"""Purchase funnels. Windows run over the stages only, whose number is given by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from eventloom.functions import position_in, recode, safe_divide

# Stages in order, and their labels.
STAGES = ("view_item", "add_to_cart", "begin_checkout", "add_payment_info", "purchase")
LABELS = {
    "view_item": "View Item",
    "add_to_cart": "Add to Cart",
    "begin_checkout": "Begin Checkout",
    "add_payment_info": "Add Payment",
    "purchase": "Purchase",
}
SHORT_STAGES = ("view_item", "add_to_cart", "begin_checkout", "purchase")


def stage_users(events: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Distinct users per stage."""
    return (
        events.where(F.col("event_name").isin(*stages))
        .groupBy("event_name")
        .agg(F.countDistinct("user_pseudo_id").alias("users"))
    )


def funnel_stages(events: DataFrame, stages: Sequence[str] = STAGES, labels: dict[str, str] = LABELS) -> DataFrame:
    """Users per stage with their share of the largest stage, of the previous stage, and the drop-off."""
    ordered = Window.orderBy("stage_order")
    every = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        stage_users(events, stages)
        .withColumn("stage_label", recode(F.col("event_name"), labels))
        .withColumn("stage_order", position_in(F.col("event_name"), stages))
        .withColumn("pct_of_top", safe_divide(F.col("users"), F.max("users").over(every)))
        .withColumn("pct_prev", safe_divide(F.col("users"), F.lag("users").over(ordered)))
        .withColumn("drop_off", 1 - F.col("pct_prev"))
        .orderBy("stage_order")
    )


# The funnel as SQL: {events} is the event frame, :stages the stage names in order.
FUNNEL_SQL = """
SELECT event_name, users,
       round(100.0D * users / nullif(first_value(users) OVER (ORDER BY stage), 0), 1) AS pct_of_top
FROM (SELECT event_name, array_position(:stages, event_name) AS stage, count(DISTINCT user_pseudo_id) AS users
      FROM {events}
      WHERE array_contains(:stages, event_name)
      GROUP BY event_name)
ORDER BY stage
"""


def funnel_sql(events: DataFrame, stages: Sequence[str] = SHORT_STAGES) -> DataFrame:
    """Users per stage and their percentage of the first stage, through the SQL surface."""
    return events.sparkSession.sql(FUNNEL_SQL, {"stages": F.array(*[F.lit(s) for s in stages])}, events=events)
