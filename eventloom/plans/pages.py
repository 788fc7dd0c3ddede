"""Page performance from the long parameter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions import page_section, url_path, url_path_keep_fragment, url_path_one_pass

PAGE_KEY = "page_location"


def page_locations(params: DataFrame) -> DataFrame:
    return params.where(F.col("key") == PAGE_KEY)


def page_view_extract(params: DataFrame) -> DataFrame:
    """Date, user and page of each page view."""
    views = page_locations(params).where(F.col("event_name") == "page_view")
    return views.select("event_date", "user_pseudo_id", "param_value")


def with_sections(params: DataFrame) -> DataFrame:
    """Page views with ``page_path`` and ``section``."""
    views = page_locations(params).where((F.col("event_name") == "page_view") & F.col("param_value").isNotNull())
    return views.withColumn("page_path", url_path(F.col("param_value"))).withColumn(
        "section", page_section(F.col("page_path"))
    )


def page_performance(params: DataFrame) -> DataFrame:
    """Views and users per section and path."""
    return (
        with_sections(params)
        .groupBy("section", "page_path")
        .agg(F.count(F.lit(1)).alias("page_views"), F.countDistinct("user_pseudo_id").alias("unique_users"))
    )


def path_views(params: DataFrame) -> DataFrame:
    """Views per section and path, without users.

    Page views are counted per URL first, so paths are worked out once per distinct URL.
    """
    keys = ["key", "event_name", "param_value"]
    counted = params.groupBy(*keys).agg(F.count(F.lit(1)).alias("views"))
    return with_sections(counted).groupBy("section", "page_path").agg(F.sum("views").alias("page_views"))


def top_pages(params: DataFrame, n: int = 20) -> DataFrame:
    return page_performance(params).orderBy(F.desc("page_views"), "section", "page_path").limit(n)


def page_sections(params: DataFrame) -> DataFrame:
    """Views and distinct paths per section."""
    return (
        path_views(params)
        .groupBy("section")
        .agg(F.sum("page_views").alias("page_views"), F.count(F.lit(1)).alias("paths"))
        .orderBy(F.desc("page_views"), "section")
    )


def page_views_by_device(
    params: DataFrame,
    events: DataFrame,
    keys: tuple[str, ...] = ("event_timestamp", "user_pseudo_id"),
    min_views: int = 10,
    n: int = 20,
) -> DataFrame:
    """Most viewed paths per device, joined on time and user.

    The keys are not unique on either side. Events are counted per key and device first and a page row weighs as many
    rows as the plain join would have made of it, so a frequent key never multiplies out. The page side goes into the
    join as it is, where AQE can split a frequent key.
    """
    path = url_path_keep_fragment(F.col("param_value")).alias("page_path")
    left = page_locations(params).select(*keys, path)
    right = events.groupBy(*keys, "device_category").agg(F.count(F.lit(1)).alias("n_events"))
    return (
        left.join(right, list(keys), "left")
        .groupBy("device_category", "page_path")
        .agg(
            F.sum(F.coalesce("n_events", F.lit(1))).alias("page_views"),
            F.countDistinct("user_pseudo_id").alias("users"),
        )
        .where(F.col("page_views") >= min_views)
        .orderBy(F.desc("page_views"), F.asc_nulls_last("device_category"), "page_path")
        .limit(n)
    )


def page_category_counts(params: DataFrame, categories: DataFrame) -> DataFrame:
    """Page views per category; paths without one count under NULL.

    Views are counted per URL, then per path, before the lookup. A path with two categories counts in both.
    """
    counted = page_locations(params).groupBy("param_value").agg(F.count(F.lit(1)).alias("n_url"))
    views = counted.groupBy(url_path_one_pass(F.col("param_value")).alias("page_path")).agg(F.sum("n_url").alias("views"))
    # the same (path, category) pair listed twice doubles the rows, as the plain join would
    lookup = categories.groupBy("page_path", "category").agg(F.count(F.lit(1)).alias("times"))
    return (
        views.join(lookup, "page_path", "left")
        .groupBy("category")
        .agg(F.sum(F.col("views") * F.coalesce("times", F.lit(1))).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("category"))
    )


def top_locations(params: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent page locations."""
    counts = page_locations(params).groupBy("param_value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "param_value").limit(n)


def page_views_per_user(params: DataFrame) -> DataFrame:
    """Page-view rows per user."""
    views = params.where(F.col("event_name") == "page_view")
    return views.groupBy("user_pseudo_id").agg(F.count(F.lit(1)).alias("page_views"))


def views_by_path(params: DataFrame, min_views: int) -> DataFrame:
    """Paths with at least ``min_views`` views."""
    return path_views(params).where(F.col("page_views") >= min_views).select("page_path", "page_views")
