"""Files that can be skipped by a filter on any one of several columns.

Sorting by several columns narrows the ranges of the first one only. Here every column is cut into ranges of about
equally many rows, and the bits of a row's ranges take turns in one number: rows that are close in this number are
close in every column. Files cover a run of numbers each, so their Parquet minima and maxima are narrow for all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows from which the cuts of a column are taken; they decide how even the ranges are, not which rows are written.
SAMPLE_ROWS = 20_000


def cuts(df: DataFrame, columns: Sequence[str], ranges: int, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Per column the smallest value of each range but the first, from a bounded sample of rows.

    A value that is more frequent than a range has one of its own, so there may be fewer.
    """
    rows = df.select(*columns)
    share = min(1.0, 2.0 * sample_rows / max(rows.count(), 1))
    picked = (rows if share == 1.0 else rows.sample(share, seed=7)).limit(sample_rows).collect()
    out = {}
    for i, name in enumerate(columns):
        values = sorted(row[i] for row in picked if row[i] is not None)
        least = {values[k * len(values) // ranges] for k in range(ranges)} if values else set()
        out[name] = sorted(least)[1:]
    return out


def range_number(column: Column, bounds: Sequence, ranges: int) -> Column:
    """Number of the range that a value is in, spread over 0 to ``ranges`` - 1; NULL is in the first one.

    Nested conditions halve the bounds, so a row is compared a few times only.
    """
    place = [k * ranges // (len(bounds) + 1) for k in range(len(bounds) + 1)]

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(place[low])
        middle = (low + high) // 2
        return F.when(column >= F.lit(bounds[middle]), below(middle + 1, high)).otherwise(below(low, middle))

    return below(0, len(bounds)) if bounds else F.lit(0)


def curve(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of all numbers in turn, highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - k))
    return out


def write_curved(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int | None = None,
    bloom_columns: Sequence[str] = (),
    distinct_estimate: int = 1_000_000,
    bits: int = 8,
    mode: str = "errorifexists",
) -> None:
    """Write ``df`` along a space-filling curve through the ranges of ``columns``, with bloom filters on some of them.

    ``files`` defaults to what Spark plans for a shuffle. ``df`` is read twice: once for the number of rows and a
    bounded sample, once to write it.
    """
    if not 1 <= bits * len(columns) <= 63:
        raise ValueError("the bits of all columns must fit a long")
    bounds = cuts(df, columns, 1 << bits)
    numbers = [range_number(F.col(c), bounds[c], 1 << bits) for c in columns]
    numbered = df.withColumns({f"__range_{k}": n for k, n in enumerate(numbers)})
    placed = numbered.select(*df.columns, curve([F.col(f"__range_{k}") for k in range(len(columns))], bits).alias("__place"))
    order = ["__place", *columns]
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = spread.sortWithinPartitions(*order).drop("__place").write.mode(mode)
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct_estimate
        )
    writer.parquet(path)
