"""Data-quality, storage and ingest reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventloom.functions import extract_day, parse_day, period_label
from eventloom.sources.listing import folder_files, path_exists
from eventloom.sources.readers import union_all_by_name

MEGABYTE = 1024 * 1024
# Bounds for the size of a file and the number of files of a dataset.
SMALLEST_FILE = 20 * MEGABYTE
LARGEST_FILE = 2 * 1024 * MEGABYTE
MOST_FILES = 10_000
EXPECTED_DAYS = 85


def _files_of(spark: SparkSession, folders: Sequence[str], glob: str) -> DataFrame | None:
    listed = [folder_files(spark, folder, glob) for folder in folders if path_exists(spark, folder)]
    return union_all_by_name(listed) if listed else None


def file_counts(
    spark: SparkSession, folders: dict[str, str], expected: int = EXPECTED_DAYS, glob: str = "*.parquet"
) -> DataFrame:
    """Files and a status text per folder; ``folders`` maps folder to description."""
    wanted = spark.createDataFrame(
        [(folder, text, path_exists(spark, folder)) for folder, text in folders.items()],
        "folder string, description string, present boolean",
    )
    rows = wanted.withColumn("n", F.lit(0).cast("long"))
    files = _files_of(spark, list(folders), glob)
    if files is not None:
        rows = rows.unionByName(files.select("folder", F.lit(1).cast("long").alias("n")), allowMissingColumns=True)
    # one group per folder, with the file rows next to the wanted one: a join on so few constants would be nested loops
    counted = rows.groupBy("folder").agg(
        F.max("description").alias("description"), F.max("present").alias("present"), F.sum("n").alias("n_files")
    )
    status = (
        F.when(~F.col("present"), F.lit("folder missing"))
        .when(F.col("n_files") == 0, F.lit("empty"))
        .when(F.col("n_files") < expected, F.format_string("only %d files", F.col("n_files")))
        .otherwise(F.format_string("%d files", F.col("n_files")))
    )
    return counted.select("description", "folder", "n_files", status.alias("status"))


def storage_summary(spark: SparkSession, folders: Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """Files and megabytes per existing folder, and gigabytes over all of them in the row ``total``."""
    files = _files_of(spark, folders, glob)
    if files is None:
        return spark.createDataFrame([], "folder string, n_files long, size_mb double, size_gb double")
    sums = (
        files.rollup("folder")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.grouping("folder").alias("is_total"))
    )
    folder = F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col("folder"))
    return sums.select(
        folder.alias("folder"),
        "n_files",
        F.round(F.col("bytes") / MEGABYTE, 1).alias("size_mb"),
        F.round(F.col("bytes") / (1024 * MEGABYTE), 2).alias("size_gb"),
    )


def layout_check(files: DataFrame) -> DataFrame:
    """Advice per folder from the sizes of its files (columns folder, path, length)."""
    summary = files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("length") < SMALLEST_FILE).alias("too_small"),
        F.count_if(F.col("length") > LARGEST_FILE).alias("too_large"),
        F.sum("length").alias("bytes"),
    )
    advice = (
        F.when(F.col("n_files") >= MOST_FILES, F.lit("too many files: partition by fewer columns or rebalance"))
        .when(F.col("too_large") > 0, F.lit("large files: limit the rows per file"))
        .when((F.col("too_small") > 0) & (F.col("n_files") > 1), F.lit("small files: rebalance before writing"))
        .otherwise(F.lit("ok"))
    )
    return summary.withColumn("advice", advice)


def partition_summary(df: DataFrame) -> DataFrame:
    """Rows per year and month with a period label, and the grand total in a last row without a year."""
    month_start = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    counted = (
        df.groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupingSets([["year", "month"], []], "year", "month")
        .agg(F.sum("rows").alias("n"), F.grouping("year").alias("is_total"))
    )
    label = F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(period_label(month_start))
    return counted.select(label.alias("period"), "year", "month", F.col("n").alias("rows")).orderBy(
        F.asc_nulls_last("year"), F.asc_nulls_last("month")
    )


def partition_types(df: DataFrame) -> dict[str, bool]:
    """Whether year and month are present as integers."""
    types = {f.name: f.dataType for f in df.schema}
    return {name: isinstance(types.get(name), T.IntegerType) for name in ("year", "month")}


def sample_rows(df: DataFrame, columns: Sequence[str], condition: Column | None = None, n: int = 5) -> DataFrame:
    """A few rows, in no particular order."""
    return (df if condition is None else df.where(condition)).select(*columns).limit(n)


def day_sizes(events: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """Rows per day, optionally for a few sample days (YYYYMMDD)."""
    if days is not None:
        events = events.where(F.col("event_date").isin(*days))
    return events.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


def day_size_estimate(sizes: DataFrame, days: int = 90) -> DataFrame:
    """Mean rows per day and the rows to expect for a number of days."""
    mean = F.avg("row_count")
    return sizes.agg(F.count(F.lit(1)).alias("days"), mean.alias("mean_rows"), (mean * days).alias("estimated_rows"))


def latest_log(log: DataFrame) -> DataFrame:
    """The last entry of each day of an append-only ingest log."""
    fields = [c for c in log.columns if c not in ("day", "logged_at")]
    last = F.max(F.struct("logged_at", *fields)).alias("last")
    return log.groupBy("day").agg(last).select("day", "last.*")


def ingest_status(log: DataFrame) -> DataFrame:
    """Number of days per status."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def ingest_failures(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "error")


def ingest_monthly(log: DataFrame) -> DataFrame:
    """Days, rows and mean rows per day for each month of the successful days."""
    day = parse_day(extract_day(F.col("day")))
    return (
        log.where(F.col("status") == "success")
        .withColumn("month", F.trunc(day, "month"))
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("days_loaded"),
            F.sum("rows").alias("total_rows"),
            F.round(F.avg("rows")).alias("avg_rows_per_day"),
        )
        .select(period_label(F.col("month")).alias("month_label"), "days_loaded", "total_rows", "avg_rows_per_day")
    )


def still_needed(requested: DataFrame, log: DataFrame) -> DataFrame:
    """Requested days without a successful entry in the log."""
    done = log.where(F.col("status").isin("success", "skipped")).select("day")
    return requested.join(done, "day", "left_anti")
