"""Lazy readers: one path, many paths, a glob, a partitioned folder, and the other file formats."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, types as T

from eventloom.session import fit_to_input, size_in_bytes
from eventloom.sources.listing import list_files


def _sized(read: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let the session settings grow with what is read (the file listing has the sizes already)."""

    @wraps(read)
    def sized(spark: SparkSession, *args, **kwargs) -> DataFrame:
        df = read(spark, *args, **kwargs)
        fit_to_input(spark, size_in_bytes(df))
        return df

    return sized


@_sized
def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet file or folder; ``columns`` limits what the scan reads, ``schema`` saves looking into the files."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    return df.select(*columns) if columns else df


@_sized
def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a given schema: one pass, no inference, bad values fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True)


@_sized
def read_csv_inferred(spark: SparkSession, path: str, overrides: dict[str, T.DataType] | None = None) -> DataFrame:
    """CSV whose types are inferred from all rows, except for the columns in ``overrides``.

    Inference costs a pass of its own over the files; a value that does not fit an override fails the read.
    """
    inferred = spark.read.csv(path, header=True, inferSchema=True).schema
    fixed = overrides or {}
    schema = T.StructType([T.StructField(f.name, fixed.get(f.name, f.dataType), True) for f in inferred])
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True)


@_sized
def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


@_sized
def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


@_sized
def read_file_list(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The files of ``folder`` whose name matches the regular expression, as one table."""
    paths = list_files(spark, folder, pattern)
    if not paths:
        raise FileNotFoundError(f"no file in {folder} matches {pattern}")
    return spark.read.parquet(*paths)


@_sized
def read_glob(spark: SparkSession, pattern: str, merge_schema: bool = False) -> DataFrame:
    """All files matching a glob as one table; ``merge_schema`` aligns differing files by column name."""
    return spark.read.option("mergeSchema", merge_schema).parquet(pattern)


@_sized
def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """A folder tree with ``column=value`` directories.

    Pass ``schema`` to pin the types: discovery alone turns a YYYYMMDD directory into an integer.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing from one become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
