"""Column profiles, summaries and histograms, each from one or two passes over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.operators.columns import COMPLEX_TYPES, is_numeric
from eventloom.operators.quantiles import exact_quantiles


def _as_rows(one_row: DataFrame, per_column: dict[str, Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per column."""
    entries = [F.struct(F.lit(name).alias("column_name"), entry.alias("stats")) for name, entry in per_column.items()]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.column_name", "e.stats.*")


def describe_table(df: DataFrame) -> DataFrame:
    """Position, name, type and number of non-NULL values of each column."""
    fields = list(df.schema)
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    stats = {
        f.name: F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(fields)
    }
    return _as_rows(counts, stats)


def profile(df: DataFrame, approx_distinct: bool = False, rsd: float = 0.02) -> DataFrame:
    """Missing values, completeness, smallest and largest value and mean of each flat column, in one pass."""
    fields = [f for f in df.schema if not isinstance(f.dataType, COMPLEX_TYPES)]
    aggregates, stats = [F.count(F.lit(1)).alias("rows")], {}
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        mean = F.avg(column) if is_numeric(field.dataType) else F.lit(None).cast("double")
        aggregates += [
            F.count(column).alias(f"c{i}"),
            F.min(column).cast("string").alias(f"lo{i}"),
            F.max(column).cast("string").alias(f"hi{i}"),
            F.max(mean).alias(f"m{i}") if not is_numeric(field.dataType) else mean.cast("double").alias(f"m{i}"),
        ]
        entry = [
            F.lit(field.dataType.simpleString()).alias("data_type"),
            (F.col("rows") - F.col(f"c{i}")).alias("missing"),
            F.try_divide(F.col(f"c{i}").cast("double"), F.col("rows").cast("double")).alias("complete_rate"),
            F.col(f"lo{i}").alias("smallest"),
            F.col(f"hi{i}").alias("largest"),
            F.col(f"m{i}").alias("mean"),
        ]
        if approx_distinct:
            aggregates.append(F.approx_count_distinct(column, rsd).alias(f"d{i}"))
            entry.append(F.col(f"d{i}").alias("distinct_estimate"))
        stats[field.name] = F.struct(*entry)
    return _as_rows(df.agg(*aggregates), stats)


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values and count of the most frequent value per column.

    Values are counted as text per (column, value) first, so one frequent value never meets in a single task.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    counted = (
        df.select(F.inline(cells)).where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count("v").alias("n"))
    )
    return counted.groupBy("column_name").agg(F.count("v").alias("distinct_values"), F.max("n").alias("top_count"))


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Smallest value, quartiles, mean and largest value, as one row."""
    quartiles = {"first_quartile": 0.25, "median": 0.5, "third_quartile": 0.75}
    value = F.col(column).cast("double")
    basics = df.agg(F.struct(F.min(value).alias("lo"), F.avg(value).alias("mean"), F.max(value).alias("hi"))).scalar()
    return exact_quantiles(df, column, quartiles).select(
        basics["lo"].alias("minimum"), "first_quartile", "median", basics["mean"].alias("mean"), "third_quartile",
        basics["hi"].alias("maximum"),
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` equally wide bins between the extremes; the largest value belongs to the last bin."""
    value = F.col(column).cast("double")
    limits = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    width = F.try_divide(F.col("limits.hi") - F.col("limits.lo"), F.lit(float(bins)))
    raw = F.floor(F.try_divide(value - F.col("limits.lo"), width)).cast("int") + 1
    number = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins))
    counted = (
        df.where(F.col(column).isNotNull())
        .withColumn("limits", limits)
        .groupBy(number.alias("bin"), F.col("limits.lo").alias("lo"), width.alias("width"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    start = F.col("lo") + (F.col("bin") - 1) * F.coalesce("width", F.lit(0.0))
    return counted.select("bin", start.alias("bin_start"), "n")
