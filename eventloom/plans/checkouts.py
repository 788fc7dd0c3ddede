"""Library checkouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventloom.operators.ranking import top_per_group, with_total

BOOK = "BOOK"


def _in_order(calendar: DataFrame, *order) -> DataFrame:
    """Rows of a result with one row per year or month, sorted in one task: no job to sample them for a global sort."""
    return calendar.coalesce(1).sortWithinPartitions(*order)


def checkouts_by_year(checkouts: DataFrame, suffix: str | None = None, year: int | None = None) -> DataFrame:
    """Checkouts per year, optionally for material types with a suffix and for one year."""
    if year is not None:
        checkouts = checkouts.where(F.col("CheckoutYear") == year)
    if suffix is not None:
        checkouts = checkouts.where(F.col("MaterialType").endswith(suffix))
    return _in_order(checkouts.groupBy("CheckoutYear").agg(F.sum("Checkouts").alias("checkouts")), "CheckoutYear")


def books_by_month(checkouts: DataFrame, since: int) -> DataFrame:
    """Book checkouts per month from a year on."""
    months = (
        checkouts.where((F.col("CheckoutYear") >= since) & (F.col("MaterialType") == BOOK))
        .groupBy("CheckoutYear", "CheckoutMonth")
        .agg(F.sum("Checkouts").alias("TotalCheckouts"))
    )
    return _in_order(months, "CheckoutYear", "CheckoutMonth")


def books_of_year(checkouts: DataFrame, year: int) -> DataFrame:
    """Book checkouts per month of one year, last month first."""
    months = (
        checkouts.where((F.col("CheckoutYear") == year) & (F.col("MaterialType") == BOOK))
        .groupBy("CheckoutMonth")
        .agg(F.sum("Checkouts").alias("TotalCheckouts"))
    )
    return _in_order(months, F.desc("CheckoutMonth"))


def counts_with_total(checkouts: DataFrame) -> DataFrame:
    """Rows per year, month and number of checkouts, with the sum of that number over all result rows."""
    keys = ["CheckoutYear", "CheckoutMonth", "Checkouts"]
    counted = checkouts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return with_total(counted, "Checkouts", "Total_checkouts").orderBy(*keys)


def top_title_per_year(checkouts: DataFrame, suffix: str = BOOK) -> DataFrame:
    """The title with most checkouts of each year; equal ones by title."""
    totals = (
        checkouts.where(F.col("MaterialType").endswith(suffix))
        .groupBy("CheckoutYear", "Title")
        .agg(F.sum("Checkouts").alias("checkouts"))
    )
    order = [F.desc("checkouts"), F.asc_nulls_last("Title")]
    return top_per_group(totals, ["CheckoutYear"], order, 1).drop("rank").orderBy("CheckoutYear")


def top_authors(checkouts: DataFrame, n: int = 1, suffix: str = BOOK) -> DataFrame:
    """Authors with most different titles."""
    return (
        checkouts.where(F.col("MaterialType").endswith(suffix) & F.col("Creator").isNotNull())
        .groupBy("Creator")
        .agg(F.countDistinct("Title").alias("titles"))
        .orderBy(F.desc("titles"), "Creator")
        .limit(n)
    )


def material_trend(checkouts: DataFrame, materials: Sequence[str] = ("BOOK", "EBOOK")) -> DataFrame:
    """Checkouts per year, one column per material type."""
    return (
        checkouts.where(F.col("MaterialType").isin(*materials))
        .groupBy("CheckoutYear")
        .pivot("MaterialType", list(materials))
        .agg(F.sum("Checkouts"))
        .orderBy("CheckoutYear")
    )


def is_book(checkouts: DataFrame) -> DataFrame:
    """Material type with the flag ``IsBook``."""
    flagged = checkouts.withColumn("IsBook", F.col("MaterialType").endswith(BOOK))
    return flagged.select("MaterialType", "IsBook")
