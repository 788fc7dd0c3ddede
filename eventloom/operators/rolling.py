"""Rolling means over a daily series.

The input has one row per day, so the single ordered window holds at most the days of the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def rolling_mean_rows(daily: DataFrame, day: str, value: str, name: str, before: int = 6) -> DataFrame:
    """Mean over this row and up to ``before`` preceding rows; missing days are not filled in."""
    return daily.withColumn(name, F.avg(value).over(Window.orderBy(F.asc_nulls_last(day)).rowsBetween(-before, 0)))


def rolling_mean_days(daily: DataFrame, day: str, value: str, name: str, before: int = 6) -> DataFrame:
    """Mean over the rows of this day and the ``before`` calendar days ahead of it."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    return daily.withColumn(name, F.avg(value).over(Window.orderBy(number).rangeBetween(-before, 0)))
