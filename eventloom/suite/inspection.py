"""Catalog, inspection, data-quality reports and the UDF surface."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from eventloom import catalog
from eventloom.fixtures import Tables
from eventloom.operators import (
    compute,
    describe_table,
    distinct_profile,
    frame_difference,
    histogram,
    numeric_summary,
    profile,
)
from eventloom.plans import funnel, quality, revenue, sales
from eventloom.sources import footers, read_partitioned
from eventloom.suite.registry import file_copy, query, rounded, taken_from

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query(
    "sql_over_frame",
    "ga_events",
    """SELECT CASE WHEN active >= 5 THEN 'regular' ELSE 'occasional' END AS habit, count(*) AS users, CAST(max(active) AS BIGINT) AS most_days
FROM (SELECT user_pseudo_id, count(DISTINCT event_date) AS active FROM ga_events WHERE user_pseudo_id IS NOT NULL GROUP BY 1) u
GROUP BY 1""",
)
def sql_over_frame(t: Tables) -> DataFrame:
    """Active days per user with verbs, then users by habit with SQL over the registered frame."""
    known = t.events().where(F.col("user_pseudo_id").isNotNull())
    days = known.groupBy("user_pseudo_id").agg(F.countDistinct("event_date").alias("active"))
    shop = catalog.Catalog(t.spark, read_only=True)
    shop.register("user_days", days)
    return shop.sql(
        """SELECT if(active < 5, 'occasional', 'regular') AS habit, count(*) AS users, max(active) AS most_days
           FROM user_days GROUP BY habit"""
    )


@query(
    "sql_join_case",
    "ga_events ga_sessions",
    """SELECT s.device_category, s.traffic_source_medium, count(*) FILTER (e.event_name = 'purchase') AS bought,
  count(DISTINCT e.user_pseudo_id) AS users
FROM ga_events e JOIN ga_sessions s ON s.user_pseudo_id = e.user_pseudo_id AND s.event_date = e.event_date GROUP BY ALL""",
)
def sql_join_case(t: Tables) -> DataFrame:
    """A join and a CASE in SQL over two registered frames."""
    shop = catalog.Catalog(t.spark, read_only=True)
    shop.register("shop_events", t.events())
    shop.register("shop_sessions", t.sessions())
    return shop.sql(
        """SELECT s.device_category, s.traffic_source_medium,
             sum(CASE WHEN e.event_name = 'purchase' THEN 1 ELSE 0 END) AS bought, count(DISTINCT e.user_pseudo_id) AS users
           FROM shop_events e JOIN shop_sessions s
             ON e.user_pseudo_id = s.user_pseudo_id AND e.event_date = s.event_date
           GROUP BY s.device_category, s.traffic_source_medium"""
    )


@query(
    "sql_cte_window",
    "ga_events",
    """SELECT event_name, event_date, n, CAST(r AS integer) AS place FROM (SELECT *, row_number() OVER (PARTITION BY event_name
  ORDER BY n DESC, event_date) AS r FROM (SELECT event_name, event_date, count(*) AS n FROM ga_events GROUP BY ALL) d) x
WHERE r <= 3 ORDER BY event_name, r LIMIT 12""",
)
def sql_cte_window(t: Tables) -> DataFrame:
    """Common table expressions, a window and a limit in SQL."""
    return catalog.Catalog(t.spark, read_only=True).sql(
        """WITH daily AS (SELECT event_name, event_date, count(*) AS n FROM {events} GROUP BY event_name, event_date),
             placed AS (SELECT daily.*, row_number() OVER (PARTITION BY event_name ORDER BY n DESC, event_date) AS place FROM daily)
           SELECT event_name, event_date, n, place FROM placed WHERE place <= 3 ORDER BY event_name, place LIMIT 12""",
        events=t.events(),
    )


@query("view_over_files", "", "SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1")
def view_over_files(t: Tables) -> DataFrame:
    """A view straight over files, asked in SQL."""
    shop = catalog.Catalog(t.spark, read_only=True)
    shop.register_path("event_files", f"{t.folder}/events.parquet")
    return shop.sql("SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM event_files GROUP BY event_type")


@query(
    "stored_tables",
    "",
    """SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def stored_tables(t: Tables) -> DataFrame:
    """Two tables stored in a database, bucketed on the join key, and joined from there."""
    shop = catalog.Catalog(t.spark, f"shop_{uuid.uuid4().hex}")
    shop.create_table("nation", t.base("nation"), bucket_by=["n_regionkey"], buckets=2, sort_by=["n_regionkey"])
    shop.create_table("region", t.base("region"), bucket_by=["r_regionkey"], buckets=2, sort_by=["r_regionkey"])
    joined = shop.table("nation").join(shop.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))


@query(
    "table_row_counts",
    "",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in BASE_TABLES),
)
def table_row_counts(t: Tables) -> DataFrame:
    return footers.row_counts(t.spark, {name: f"{t.folder}/{name}.parquet" for name in BASE_TABLES})


_EVENT_TYPES = (
    ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
    ("value", "double"), ("props", "string"),
)


@query(
    "schema_table",
    "",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST({i} AS integer) AS position, '{kind}' AS data_type, count({name}) AS non_null FROM events"
        for i, (name, kind) in enumerate(_EVENT_TYPES, 1)
    ),
)
def schema_table(t: Tables) -> DataFrame:
    return describe_table(t.base("events"))


@query("row_count", "", "SELECT count(*) AS rows FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return footers.count_rows(t.spark, f"{t.folder}/lineitem.parquet")


@query("compute_then_filter", "sales", "SELECT region, count(*) AS n FROM sales GROUP BY region HAVING count(*) > 100")
def compute_then_filter(t: Tables) -> DataFrame:
    return compute(sales.region_counts(t.sales())).where(F.col("n") > 100)


@query(
    "numeric_summary",
    "",
    """SELECT min(l_extendedprice) AS minimum, round(quantile_cont(l_extendedprice, 0.25), 6) AS first_quartile,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(avg(l_extendedprice), 4) AS mean,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS third_quartile, max(l_extendedprice) AS maximum FROM lineitem""",
)
def summary_of_price(t: Tables) -> DataFrame:
    result = numeric_summary(t.base("lineitem"), "l_extendedprice")
    return rounded(rounded(result, 6, "first_quartile", "median", "third_quartile"), 4, "mean")


def _profile_sql(name: str, kind: str, mean: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) - count({name}) AS missing, "
        f"count({name}) * 1.0::double / count(*) AS complete_rate, CAST(min({name}) AS varchar) AS smallest, "
        f"CAST(max({name}) AS varchar) AS largest, {mean} AS mean FROM s"
    )


@query(
    "profile_columns",
    "ga_sessions",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        _profile_sql(name, kind, mean).replace("FROM s", "FROM ga_sessions")
        for name, kind, mean in (
            ("user_pseudo_id", "bigint", "round(avg(user_pseudo_id), 4)"),
            ("event_date", "date", "CAST(NULL AS double)"),
            ("device_category", "string", "CAST(NULL AS double)"),
            ("traffic_source_medium", "string", "CAST(NULL AS double)"),
        )
    )
    + ") p",
)
def profile_columns(t: Tables) -> DataFrame:
    return rounded(profile(t.sessions()), 4, "mean")


@query(
    "profile_distinct",
    "",
    """SELECT column_name, count(*) AS distinct_values, max(n) AS top_count FROM (
  SELECT 'user_id' AS column_name, CAST(user_id AS varchar) AS v, count(*) AS n FROM events GROUP BY 2
  UNION ALL SELECT 'event_type', event_type, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY 2) x WHERE v IS NOT NULL GROUP BY 1""",
)
def profile_distinct(t: Tables) -> DataFrame:
    return distinct_profile(t.base("events"), ["user_id", "event_type", "props"])


@query(
    "quantity_histogram",
    "",
    """SELECT bin, round(lo + (bin - 1) * width, 6) AS bin_start, count(*) AS n
FROM (SELECT least(CAST(floor((l_quantity - lo) / width) AS integer) + 1, 10) AS bin, lo, width
      FROM lineitem, (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 10.0 AS width FROM lineitem) b) q
GROUP BY bin, lo, width""",
)
def quantity_histogram(t: Tables) -> DataFrame:
    return rounded(histogram(t.base("lineitem"), "l_quantity", 10), 6, "bin_start")


@query(
    "lazy_eager_diff",
    "ga_events",
    """SELECT count(*) AS days, CAST(0 AS bigint) AS differing
FROM (SELECT event_date FROM ga_events WHERE event_name = 'purchase' GROUP BY event_date) d""",
)
def lazy_eager_diff(t: Tables) -> DataFrame:
    """The same result through two read paths: the one file, and the copy split into days."""
    one_file = rounded(revenue.purchase_by_day(t.events()), 6, "revenue")
    by_day = rounded(revenue.purchase_by_day(read_partitioned(t.spark, file_copy(t, "events_by_day"))), 6, "revenue")
    differing = frame_difference(one_file, by_day).select(F.count(F.lit(1))).scalar()
    return one_file.agg(F.count(F.lit(1)).alias("days")).withColumn("differing", differing)


@query(
    "funnel_sql",
    "ga_events",
    """SELECT event_name, users, round(CAST(100.0 AS double) * users / nullif(first(users) OVER (ORDER BY pos), 0), 1) AS pct_of_top
FROM (SELECT event_name, pos, count(DISTINCT user_pseudo_id) AS users
      FROM ga_events JOIN (VALUES ('view_item', 1), ('add_to_cart', 2), ('begin_checkout', 3), ('purchase', 4)) s(name, pos)
        ON event_name = name GROUP BY event_name, pos) f""",
)
def funnel_by_sql(t: Tables) -> DataFrame:
    return funnel.funnel_sql(t.events())




@query(
    "partition_summary",
    "",
    """SELECT strftime(make_date(y, m, 1), '%b %Y') AS period, y AS year, m AS month, n AS rows
FROM (SELECT CAST(year(o_orderdate) AS integer) AS y, CAST(month(o_orderdate) AS integer) AS m, count(*) AS n
      FROM orders GROUP BY 1, 2) g
UNION ALL SELECT 'Total', NULL, NULL, count(*) FROM orders""",
)
def partition_summary(t: Tables) -> DataFrame:
    dated = t.base("orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return quality.partition_summary(dated)


@query(
    "sample_events",
    "ga_events",
    "SELECT CAST(least(5, count(*)) AS integer) AS n, CAST(least(5, count(*)) AS integer) AS n_of_table FROM ga_events WHERE event_name = 'purchase'",
)
def sample_events(t: Tables) -> DataFrame:
    """Five purchases, in no particular order: how many came, and how many of them the table holds."""
    columns = ["event_date", "event_name", "user_pseudo_id", "device_category"]
    purchases = t.events().where(F.col("event_name") == "purchase").select(*columns)
    return taken_from(quality.sample_rows(t.events(), columns, F.col("event_name") == "purchase"), purchases)


@query(
    "day_size_estimate",
    "ga_events",
    """SELECT count(*) AS days, round(avg(n), 6) AS mean_rows, round(avg(n) * 90, 6) AS estimated_rows
FROM (SELECT event_date, count(*) AS n FROM ga_events GROUP BY event_date) d""",
)
def day_size_estimate(t: Tables) -> DataFrame:
    return rounded(quality.day_size_estimate(quality.day_sizes(t.events())), 6, "mean_rows", "estimated_rows")


@query("ingest_status", "order_days", "SELECT status, count(*) AS tables FROM order_days GROUP BY status")
def ingest_status(t: Tables) -> DataFrame:
    return quality.ingest_status(t.order_days())


@query(
    "ingest_monthly",
    "order_days",
    """SELECT strftime(date_trunc('month', date), '%b %Y') AS month_label, count(*) AS days_loaded,
  CAST(sum(rows) AS bigint) AS total_rows, round(avg(rows)) AS avg_rows_per_day
FROM order_days WHERE status = 'success' GROUP BY 1""",
)
def ingest_monthly(t: Tables) -> DataFrame:
    return quality.ingest_monthly(t.order_days())


@query("ingest_failures", "order_days", "SELECT day, status FROM order_days WHERE status = 'error'")
def ingest_failures(t: Tables) -> DataFrame:
    return quality.ingest_failures(t.order_days()).select("day", "status")




@F.pandas_udf(T.StringType())
def _bracketed(names: pd.Series) -> pd.Series:
    return "[" + names + "]"


@query("udf_label", "ga_events", "SELECT '[' || event_name || ']' AS label, count(*) AS n FROM ga_events GROUP BY 1")
def udf_label(t: Tables) -> DataFrame:
    """A user function on the grouped rows, so Python sees one row per event name."""
    counted = t.events().groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(_bracketed("event_name").alias("label"), "n")
