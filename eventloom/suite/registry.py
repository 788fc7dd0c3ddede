"""Registration of queries and shared helpers."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.fixtures import Tables, with_ctes
from eventloom.session import tune
from eventloom.sources.writers import convert, write_parquet, write_partitioned
from eventloom.workspace import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_COPIES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], str]] = WeakKeyDictionary()


def query(name: str, ctes: str = "", sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with the SQL that must give the same rows."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(tune(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_ctes(ctes, sql)
        return function

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def taken_from(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Number of rows, and of rows that the table holds."""
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in rows.columns]
    found = rows.alias("a").join(table.distinct().alias("b"), same, "left_semi")
    counts = rows.select(F.lit(0).alias("of_table")).unionAll(found.select(F.lit(1)))
    return counts.agg(
        F.count_if(F.col("of_table") == 0).cast("int").alias("n"), F.count_if(F.col("of_table") == 1).cast("int").alias("n_of_table")
    )


# Column types of the Parquet copies of the checkouts.
CHECKOUT_COPY_SCHEMA = (
    "MaterialType string, CheckoutYear int, CheckoutMonth int, Checkouts bigint, Title string, ISBN string, Creator string"
)


def _checkout_file(t: Tables) -> DataFrame:
    return t.checkouts().select(
        "MaterialType", "CheckoutYear", "CheckoutMonth", "Checkouts", "Title", F.lit(None).cast("string").alias("ISBN"), "Creator"
    )


def _sales_file(t: Tables) -> DataFrame:
    return t.sales().select("region", "category", "year", "sales")


def _daily_events(t: Tables) -> DataFrame:
    return t.events().withColumn("day", F.date_format("event_date", "yyyyMMdd"))


def _write_days(t: Tables, path: str) -> None:
    """One folder per day, and one whose name holds a day but is not that day's."""
    write_partitioned(_daily_events(t), path, ["day"])
    write_parquet(t.events().where(F.col("event_date") == "2024-01-10"), f"{path}/day=intraday_20240110")


# How each file copy of the test tables is written.
_WRITERS: dict[str, Callable[[Tables, str], None]] = {
    "checkouts_csv": lambda t, path: convert(_checkout_file(t), path, "csv"),
    "checkouts_parquet": lambda t, path: write_parquet(_checkout_file(t), path),
    "checkouts_by_year": lambda t, path: write_partitioned(_checkout_file(t), path, ["CheckoutYear"]),
    "sales_json": lambda t, path: convert(_sales_file(t), path, "json"),
    "sales_orc": lambda t, path: convert(_sales_file(t), path, "orc"),
    "days_and_intraday": _write_days,
    "events_by_day": lambda t, path: write_partitioned(_daily_events(t), path, ["day"]),
}


def file_copy(t: Tables, kind: str) -> str:
    """Path of a copy of a test table in another layout, written once per session."""
    known, key = _COPIES.setdefault(t.spark, {}), (t.folder, kind)
    if key not in known:
        path = new_folder(t.spark, kind)
        _WRITERS[kind](t, path)
        known[key] = path
    return known[key]
