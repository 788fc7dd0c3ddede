"""Counts and extremes of Parquet files from their footers, without reading a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.session import tune

_SESSIONS: WeakKeyDictionary[SparkSession, SparkSession] = WeakKeyDictionary()
SOURCES = "spark.sql.sources.useV1SourceList"


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session next to ``spark`` whose Parquet scans answer aggregates from footers; ``spark`` itself stays as it is."""
    if spark not in _SESSIONS:
        session = tune(spark.newSession())
        others = [s for s in spark.conf.get(SOURCES).split(",") if s.strip() and s.strip() != "parquet"]
        session.conf.set(SOURCES, ",".join(others))
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        _SESSIONS[spark] = session
    return _SESSIONS[spark]


def count_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """One row: the number of ``rows`` below the paths."""
    return _footer_session(spark).read.parquet(*paths).agg(F.count(F.lit(1)).alias("rows"))


def row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per named path: ``table_name`` and ``rows``."""
    counts = [count_rows(spark, path).select(F.lit(name).alias("table_name"), "rows") for name, path in paths.items()]
    return reduce(DataFrame.unionAll, counts)


def extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row per column: its ``non_null`` values, ``minimum`` and ``maximum`` as text.

    Whole numbers, dates, floats and booleans come from the footers; Spark reads the rows for types whose footers are
    not exact (text, timestamps of the old kind).
    """
    read = _footer_session(spark).read.parquet(path)
    found = read.agg(
        *(f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("non_null", F.count), ("lo", F.min), ("hi", F.max)))
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"non_null_{i}").alias("non_null"),
            F.col(f"lo_{i}").cast("string").alias("minimum"), F.col(f"hi_{i}").cast("string").alias("maximum"),
        )
        for i, c in enumerate(columns)
    ]
    return found.select(F.inline(F.array(*entries)))
