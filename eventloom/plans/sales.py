"""Sales by region, year and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sales_by_region(sales: DataFrame, since: int | None = None) -> DataFrame:
    """Total sales per region, largest first, optionally from a year on."""
    if since is not None:
        sales = sales.where(F.col("year") >= since)
    return sales.groupBy("region").agg(F.sum("sales").alias("total_sales")).orderBy(F.desc("total_sales"), "region")


def sales_by_year(sales: DataFrame) -> DataFrame:
    """Revenue per year."""
    return sales.groupBy("year").agg(F.sum("revenue").alias("total")).orderBy("year")


def average_price(sales: DataFrame, category: str) -> DataFrame:
    """Mean price of one category."""
    return sales.where(F.col("category") == category).agg(F.avg("price").alias("avg_price"))


def region_counts(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
