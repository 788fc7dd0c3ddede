"""Per-day storage: entries named ``<prefix>YYYYMMDD``, with or without an ending, below a root folder.

The day is in the name, so a date range is resolved to paths before Spark reads anything. A filter on
``_metadata.file_path`` would still list and schedule every file. The name must begin with the prefix and the day must
end where its eight digits do: ``events_intraday_20240101`` is no day of the prefix ``events_``, and neither is
``events_202401011``.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom.functions.dates import day_suffix
from eventloom.session import fit_to_input, size_in_bytes
from eventloom.sources.listing import list_files

PREFIX = "events_"


def day_pattern(prefix: str = PREFIX) -> str:
    """Regular expression of an entry's whole name; the group is the day."""
    return rf"^{re.escape(prefix)}(\d{{8}})(?:\D.*)?$"


def list_day_paths(spark: SparkSession, root: str, prefix: str = PREFIX) -> dict[str, list[str]]:
    """Day key to the paths that hold it. A day may have several (a late second file)."""
    days: dict[str, list[str]] = {}
    for path in list_files(spark, root, day_pattern(prefix)):
        days.setdefault(re.match(day_pattern(prefix), path.rsplit("/", 1)[-1]).group(1), []).append(path)
    return days


def available_days(spark: SparkSession, root: str, prefix: str = PREFIX) -> DataFrame:
    """One row per stored day."""
    schema = T.StructType([T.StructField("day", T.StringType(), False)])
    return spark.createDataFrame([(day,) for day in sorted(list_day_paths(spark, root, prefix))], schema)


def read_days(
    spark: SparkSession, root: str, days: Iterable[str], schema: T.StructType | None = None, prefix: str = PREFIX
) -> DataFrame:
    """The given days as one table. Without ``schema`` the columns of all files are merged by name."""
    stored = list_day_paths(spark, root, prefix)
    paths = [path for day in sorted(set(days)) for path in stored.get(day, [])]
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"none of the requested days is stored below {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    fit_to_input(spark, size_in_bytes(df))
    return df


def read_day_range(
    spark: SparkSession,
    root: str,
    first: dt.date,
    last: dt.date,
    schema: T.StructType | None = None,
    prefix: str = PREFIX,
) -> DataFrame:
    """Days between ``first`` and ``last``, both included; days that are not stored are left out."""
    low, high = first.strftime("%Y%m%d"), last.strftime("%Y%m%d")
    wanted = [day for day in list_day_paths(spark, root, prefix) if low <= day <= high]
    return read_days(spark, root, wanted, schema, prefix)


def day_plan(requested: DataFrame, available: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the requested days (column ``day``) into those present and those missing."""
    stored = available.select("day")
    return requested.join(stored, "day", "left_semi"), requested.join(stored, "day", "left_anti")


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day between two dates: ``date`` and the YYYYMMDD ``day``."""
    span = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("date")).withColumn("day", day_suffix(F.col("date")))


def calendar_of(df: DataFrame, date_column: str) -> DataFrame:
    """One row per day between the first and the last date that occurs in ``df``."""
    bounds = df.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi"))
    span = F.sequence("lo", "hi", F.expr("interval 1 day"))
    return bounds.select(F.explode(span).alias("date")).withColumn("day", day_suffix(F.col("date")))
