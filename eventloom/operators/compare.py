"""Equality of two frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often in both frames, with ``surplus`` (positive: more in ``left``).

    One shuffle with map-side counting: duplicates collapse before they travel. NULLs compare equal.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the frames have different columns")
    both = left.withColumn("__sign", F.lit(1)).unionByName(right.withColumn("__sign", F.lit(-1)))
    return both.groupBy(*left.columns).agg(F.sum("__sign").alias("surplus")).where("surplus <> 0")
