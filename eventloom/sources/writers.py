"""Parquet writers: plain, partitioned, clustered for point filters, and format conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

MAX_ROWS_PER_FILE = 500_000


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "errorifexists") -> None:
    """Write as many files as the plan has partitions; codecs are snappy, gzip, zstd, lz4 or none."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    compression: str = "snappy",
    max_rows_per_file: int | None = None,
    mode: str = "errorifexists",
    replace_only_present: bool = False,
    rebalance: bool = True,
) -> None:
    """One directory level per column in ``by``.

    The rebalance step brings the rows of a directory together so that small directories get one file, and lets AQE
    split a directory that is larger than the advisory size over several tasks. Turn it off when the input files are
    large and each belongs to one directory already: the tasks then write what they read, without a shuffle.
    ``replace_only_present`` overwrites just the directories that occur in ``df``.
    """
    if rebalance:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode).option("compression", compression).partitionBy(*by)
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if replace_only_present:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str],
    bloom_columns: Sequence[str] = (),
    distinct_estimate: int = 1_000_000,
    mode: str = "errorifexists",
) -> None:
    """Files with narrow min/max ranges of ``sort_by`` and bloom filters on ``bloom_columns``.

    This is what replaces an index: row groups that cannot hold the wanted value are skipped. The range partitioning
    gets every sort column, so a frequent first value still spreads over several tasks.
    """
    writer = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode(mode)
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct_estimate
        )
    writer.parquet(path)


def convert(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Write ``df`` in another format (parquet, orc, json, csv)."""
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.options(**options).save(path)
