"""Top rows per group and shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank_name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank.

    Spark limits each map task to ``n`` rows per group before the shuffle (WindowGroupLimit), so a large group does
    not travel whole. End ``order`` with columns that make it total.
    """
    ranked = df.withColumn(rank_name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(rank_name) <= n)


def with_total(grouped: DataFrame, value: str, name: str) -> DataFrame:
    """Add the grand total of ``value`` to each row of an already grouped frame.

    The total is a scalar subquery over the same grouping: no join, and no window that pulls all groups into one task.
    Nothing runs before the result is asked for. A subquery is planned by itself, and Spark shares an exchange with it
    only if both ask for the same columns; so it takes a checksum over all of them along with the total, and the
    grouping runs once.
    """
    whole = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in grouped.columns]))
    total = grouped.agg(F.struct(F.sum(value).alias("total"), whole.alias("whole"))).scalar()
    return grouped.withColumn(name, total.getField("total"))


def share_of_total(grouped: DataFrame, value: str, name: str) -> DataFrame:
    """Add the share of ``value`` in its grand total (NULL when the total is zero)."""
    total = with_total(grouped, value, "__total")
    ratio = F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double"))
    return total.withColumn(name, ratio).drop("__total")
