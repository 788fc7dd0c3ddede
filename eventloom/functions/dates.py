"""Date helpers around the YYYYMMDD day key and the microsecond timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAY_FORMAT = "yyyyMMdd"


def parse_day(text: Column) -> Column:
    """YYYYMMDD text to a date; NULL when it is not exactly eight digits forming a date.

    Integer arithmetic instead of a pattern and a date format, which cost far more per row.
    """
    digits = F.when(F.length(text) == 8, text.try_cast("int"))
    year, month, day = F.floor(digits / 10_000), F.floor(digits / 100) % 100, digits % 100
    valid = (digits >= 10_000_000) & month.between(1, 12) & (day >= 1)
    date = F.date_add(F.when(valid, F.make_date(year.cast("int"), month.cast("int"), F.lit(1))), day - 1)
    return F.when(F.month(date) == month, date)


def day_suffix(day: Column) -> Column:
    """Date to YYYYMMDD text."""
    return F.date_format(day, DAY_FORMAT)


def event_time(micros: Column) -> Column:
    """Microseconds since the epoch to a timestamp, without going through a floating point number."""
    return F.timestamp_micros(micros)


def month_floor(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def period_label(day: Column) -> Column:
    """Short month and year, such as ``Nov 2020``."""
    return F.date_format(day, "MMM yyyy")


def to_integer(text: Column) -> Column:
    """Integer of a text, NULL when it is none."""
    return text.try_cast("int")


def with_date_parts(df: DataFrame, day_column: str = "event_date", micros_column: str = "event_timestamp") -> DataFrame:
    """Add year, month, day and ``event_dt`` derived from the day key and the timestamp."""
    day = parse_day(F.col(day_column))
    parts = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    if micros_column in df.columns:
        parts["event_dt"] = event_time(F.col(micros_column))
    return df.withColumns(parts)


def with_partition_columns(df: DataFrame, day_column: str = "event_date") -> DataFrame:
    """Add integer year and month cut out of the day key."""
    return df.withColumns(
        {
            "year": to_integer(F.substring(day_column, 1, 4)),
            "month": to_integer(F.substring(day_column, 5, 2)),
        }
    )
