"""Projections, filters, joins, aggregates, windows, sorting and set operations on their own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from eventloom.fixtures import Tables
from eventloom.functions import not_in, url_path
from eventloom.operators import across, drop_complex, session_activity, share_of_total, top_per_group
from eventloom.operators.columns import is_numeric
from eventloom.plans import checkouts, engagement, events, pages, products, traffic
from eventloom.sources import union_all_by_name
from eventloom.suite.registry import taken_from, query, rounded


def _count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


@query("select_cols", "ga_events", "SELECT event_date, event_name, user_pseudo_id FROM ga_events")
def select_cols(t: Tables) -> DataFrame:
    return t.events().select("event_date", "event_name", "user_pseudo_id")


@query(
    "drop_complex",
    "ga_events",
    """SELECT strftime(event_date, '%Y%m%d') AS event_date, epoch_us(event_ts) AS event_timestamp, event_name,
  CAST(user_pseudo_id AS varchar) AS user_pseudo_id FROM ga_events""",
)
def drop_nested(t: Tables) -> DataFrame:
    return drop_complex(t.events_raw())


@query("rename_param", "ga_params", "SELECT event_id, param_value AS page_location FROM ga_params WHERE key = 'page_location'")
def rename_param(t: Tables) -> DataFrame:
    renamed = pages.page_locations(t.params()).withColumnRenamed("param_value", "page_location")
    return renamed.select("event_id", "page_location")


@query(
    "mutate_flag",
    "checkouts",
    "SELECT MaterialType, MaterialType LIKE '%BOOK' AS IsBook, count(*) AS n FROM checkouts GROUP BY 1, 2",
)
def mutate_flag(t: Tables) -> DataFrame:
    return checkouts.is_book(t.checkouts()).groupBy("MaterialType", "IsBook").agg(_count())


@query(
    "filter_and",
    "ga_events",
    """SELECT event_date, count(*) AS n FROM ga_events
WHERE event_name = 'purchase' AND device_category = 'mobile' GROUP BY 1""",
)
def filter_and(t: Tables) -> DataFrame:
    chosen = t.events().where((F.col("event_name") == "purchase") & (F.col("device_category") == "mobile"))
    return chosen.groupBy("event_date").agg(_count())


@query(
    "filter_in",
    "ga_sessions",
    """SELECT traffic_source_medium, count(*) AS n, traffic_source_medium IN ('cpc', 'ppc') AS paid
FROM ga_sessions WHERE traffic_source_medium IN ('cpc', 'ppc', 'organic') GROUP BY 1""",
)
def filter_in(t: Tables) -> DataFrame:
    medium = F.col("traffic_source_medium")
    counted = t.sessions().where(medium.isin("cpc", "ppc", "organic")).groupBy("traffic_source_medium").agg(_count())
    return counted.withColumn("paid", medium.isin("cpc", "ppc"))


@query(
    "filter_not_in",
    "ga_sessions",
    """SELECT traffic_source_medium, count(*) AS n FROM ga_sessions
WHERE NOT coalesce(traffic_source_medium IN ('cpc', 'ppc', 'organic'), false) GROUP BY 1""",
)
def filter_not_in(t: Tables) -> DataFrame:
    """NULL is not one of the excluded media, so it stays."""
    kept = t.sessions().where(not_in(F.col("traffic_source_medium"), ["cpc", "ppc", "organic"]))
    return kept.groupBy("traffic_source_medium").agg(_count())


@query(
    "filter_not_null",
    "ga_sessions",
    "SELECT device_category, count(*) AS n FROM ga_sessions WHERE traffic_source_medium IS NOT NULL GROUP BY 1",
)
def filter_not_null(t: Tables) -> DataFrame:
    return t.sessions().where(F.col("traffic_source_medium").isNotNull()).groupBy("device_category").agg(_count())


@query(
    "filter_date_range",
    "ga_events",
    """SELECT event_date, count(*) AS n FROM ga_events
WHERE event_date >= DATE '2024-01-10' AND event_date <= DATE '2024-01-20' GROUP BY 1""",
)
def filter_date_range(t: Tables) -> DataFrame:
    """Typed dates on both sides; text in another format would compare wrongly."""
    inside = t.events().where(F.col("event_date").between(F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 1, 20))))
    return inside.groupBy("event_date").agg(_count())


@query(
    "having_min_views",
    "sectioned",
    "SELECT page_path, count(*) AS page_views FROM sectioned GROUP BY section, page_path HAVING count(*) >= 10",
)
def having_min_views(t: Tables) -> DataFrame:
    return pages.views_by_path(t.params(), 10)


@query(
    "across_sum",
    "",
    """SELECT CAST(sum(l_orderkey) AS bigint) AS l_orderkey_sum, CAST(sum(l_partkey) AS bigint) AS l_partkey_sum,
  CAST(sum(l_suppkey) AS bigint) AS l_suppkey_sum, CAST(sum(l_linenumber) AS bigint) AS l_linenumber_sum,
  round(sum(l_quantity), 2) AS l_quantity_sum, round(sum(l_extendedprice), 2) AS l_extendedprice_sum,
  round(sum(l_discount), 2) AS l_discount_sum, round(sum(l_tax), 2) AS l_tax_sum FROM lineitem""",
)
def across_sum(t: Tables) -> DataFrame:
    lines = t.base("lineitem")
    sums = lines.agg(*across(lines, is_numeric, F.sum, "_sum"))
    return rounded(sums, 2, "l_quantity_sum", "l_extendedprice_sum", "l_discount_sum", "l_tax_sum")


@query(
    "join_null_safe",
    "ga_sessions ga_events",
    """SELECT s.traffic_source_medium, s.n AS sessions, b.n AS buyer_sessions
FROM (SELECT traffic_source_medium, count(*) AS n FROM ga_sessions GROUP BY 1) s
JOIN (SELECT traffic_source_medium, count(*) AS n FROM ga_sessions
      WHERE user_pseudo_id IN (SELECT user_pseudo_id FROM ga_events WHERE event_name = 'purchase') GROUP BY 1) b
  ON s.traffic_source_medium IS NOT DISTINCT FROM b.traffic_source_medium""",
)
def join_null_safe(t: Tables) -> DataFrame:
    """NULL media match each other, as in frames where missing keys are equal."""
    sessions = t.sessions()
    every = sessions.groupBy("traffic_source_medium").agg(_count("sessions"))
    buyers = sessions.join(traffic.purchasers(t.events()), "user_pseudo_id", "left_semi")
    bought = buyers.groupBy(F.col("traffic_source_medium").alias("medium")).agg(_count("buyer_sessions"))
    matched = every.join(bought, every["traffic_source_medium"].eqNullSafe(bought["medium"]))
    return matched.select("traffic_source_medium", "sessions", "buyer_sessions")


@query("purchasers", "ga_events", "SELECT DISTINCT user_pseudo_id FROM ga_events WHERE event_name = 'purchase'")
def purchasers(t: Tables) -> DataFrame:
    return traffic.purchasers(t.events())


@query("event_users", "ga_events", "SELECT event_name, count(DISTINCT user_pseudo_id) AS users FROM ga_events GROUP BY 1")
def event_users(t: Tables) -> DataFrame:
    return events.event_users(t.events())


@query(
    "pivot_events",
    "ga_events",
    """SELECT event_date, count(CASE WHEN event_name = 'view_item' THEN 1 END) AS view_item,
  count(CASE WHEN event_name = 'add_to_cart' THEN 1 END) AS add_to_cart,
  count(CASE WHEN event_name = 'purchase' THEN 1 END) AS purchase FROM ga_events GROUP BY 1""",
)
def pivot_events(t: Tables) -> DataFrame:
    return events.pivot_events(t.events(), ["view_item", "add_to_cart", "purchase"])


@query(
    "p99_session_duration",
    "gap_sessions",
    """SELECT device_category, count(*) AS sessions, round(quantile_cont(duration_s, 0.99), 4) AS p99_duration_s
FROM gap_sessions GROUP BY 1""",
)
def p99_session_duration(t: Tables) -> DataFrame:
    sessions = session_activity(t.timed_events(), per_user=["device_category"])
    return rounded(engagement.p99_session_duration(sessions), 4, "p99_duration_s")


@query(
    "bounce_rate",
    "numbered",
    r"""SELECT page_path, count(*) AS sessions, count(CASE WHEN events = 1 THEN 1 END) AS bounces,
  count(CASE WHEN events = 1 THEN 1 END) * CAST(1.0 AS double) / count(*) AS bounce_rate
FROM (SELECT user_pseudo_id, session_number, count(*) AS events, arg_min(path, event_id) AS page_path
      FROM (SELECT n.user_pseudo_id, n.session_number, n.event_id,
              CASE WHEN p.p0 = '' THEN '/' ELSE p.p0 END AS path
            FROM numbered n JOIN (SELECT event_id, regexp_replace(regexp_replace(regexp_replace(url,
                '^https?://[^/]+', ''), '\?.*$', ''), '#.*$', '') AS p0
              FROM events JOIN pages ON page_id = event_id % (SELECT count(*) FROM pages)) p USING (event_id)) x
      GROUP BY 1, 2) s GROUP BY 1""",
)
def bounce_rate(t: Tables) -> DataFrame:
    paged = t.paged_events().select(
        "event_id",
        F.col("user_id").alias("user_pseudo_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        "url",
    )
    sessions = session_activity(paged, keep_first=["url"], order_by=["event_id"])
    return engagement.bounce_rate(sessions.withColumn("page_path", url_path(F.col("url"))))


@query(
    "category_share",
    "ga_items",
    """SELECT item_category, units, units / CAST(sum(units) OVER () AS double) AS units_pct
FROM (SELECT item_category, CAST(sum(quantity) AS bigint) AS units FROM ga_items WHERE item_name IS NOT NULL GROUP BY 1) c""",
)
def category_share(t: Tables) -> DataFrame:
    totals = products.category_totals(t.items()).select("item_category", "units")
    return share_of_total(totals, "units", "units_pct")


@query(
    "session_rank",
    "gap_sessions",
    """SELECT device_category, user_pseudo_id, session_number, n_events AS events, round(duration_s, 6) AS duration_s, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY device_category
        ORDER BY duration_s DESC, user_pseudo_id, session_number) AS integer) AS rank FROM gap_sessions) r
WHERE rank <= 3""".replace("session_number, n_events", "CAST(session_number AS bigint) AS session_number, n_events"),
)
def session_rank(t: Tables) -> DataFrame:
    sessions = session_activity(t.timed_events(), per_user=["device_category"])
    ranked = engagement.longest_sessions(sessions).drop("first_us", "last_us")
    return rounded(ranked, 6, "duration_s")


@query(
    "session_lag",
    "gap_sessions",
    """SELECT device_category, count(pause_s) AS returns, round(avg(pause_s), 3) AS mean_pause_s
FROM (SELECT device_category, (epoch_us(first_ts) - lag(epoch_us(last_ts)) OVER (PARTITION BY user_pseudo_id
        ORDER BY session_number)) / 1000000.0 AS pause_s FROM gap_sessions) g GROUP BY 1""",
)
def session_lag(t: Tables) -> DataFrame:
    sessions = session_activity(t.timed_events(), per_user=["device_category"])
    return rounded(engagement.return_times(sessions), 3, "mean_pause_s")


@query(
    "top_page_per_section",
    "sectioned",
    """SELECT section, page_path, page_views, unique_users, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY section ORDER BY page_views DESC, page_path) AS integer) AS rank
  FROM (SELECT section, page_path, count(*) AS page_views, count(DISTINCT user_pseudo_id) AS unique_users
        FROM sectioned GROUP BY 1, 2) g) r WHERE rank <= 3""",
)
def top_page_per_section(t: Tables) -> DataFrame:
    order = [F.desc("page_views"), F.col("page_path")]
    return top_per_group(pages.page_performance(t.params()), ["section"], order, 3)


@query(
    "order_mixed",
    "checkouts",
    """SELECT CheckoutYear, CheckoutMonth, TotalCheckouts, CAST(row_number() OVER (
    ORDER BY CheckoutYear DESC NULLS LAST, CheckoutMonth ASC NULLS FIRST) AS integer) AS position
FROM (SELECT CASE WHEN CheckoutYear <> 1999 THEN CheckoutYear END AS CheckoutYear,
        CASE WHEN CheckoutMonth <> 2 THEN CheckoutMonth END AS CheckoutMonth, CAST(sum(Checkouts) AS bigint) AS TotalCheckouts
      FROM checkouts WHERE CheckoutYear >= 1998 AND MaterialType = 'BOOK' GROUP BY 1, 2) m""",
)
def order_mixed(t: Tables) -> DataFrame:
    """Two directions and two places for NULL; the position makes the order a value that can be compared."""
    gaps = t.checkouts().withColumns(
        {
            "CheckoutYear": F.col("CheckoutYear").cast("int"),
            "open_year": F.when(F.col("CheckoutYear") != 1999, F.col("CheckoutYear").cast("int")),
            "open_month": F.when(F.col("CheckoutMonth") != 2, F.col("CheckoutMonth").cast("int")),
        }
    )
    months = (
        gaps.where((F.col("CheckoutYear") >= 1998) & (F.col("MaterialType") == "BOOK"))
        .groupBy(F.col("open_year").alias("CheckoutYear"), F.col("open_month").alias("CheckoutMonth"))
        .agg(F.sum("Checkouts").alias("TotalCheckouts"))
    )
    ordered = months.orderBy(F.desc_nulls_last("CheckoutYear"), F.asc_nulls_first("CheckoutMonth"))
    # a year has twelve months: the sorted rows are few, and they are numbered as they come
    listed = ordered.agg(F.collect_list(F.struct("CheckoutYear", "CheckoutMonth", "TotalCheckouts")).alias("rows"))
    return listed.select(F.posexplode("rows")).select("col.*", (F.col("pos") + 1).alias("position"))


@query("head_unsorted", "checkouts", "SELECT 20 AS n, 20 AS n_of_table")
def head_unsorted(t: Tables) -> DataFrame:
    """Any twenty rows: how many they are, and how many of them are rows of the table."""
    books = checkouts.is_book(t.checkouts())
    return taken_from(books.limit(20), books)


@query(
    "union_all_days",
    "",
    """SELECT 'events' AS source, CAST(ts AS date) AS date, count(*) AS rows, count(DISTINCT user_id) AS users,
  CAST(NULL AS double) AS total FROM events GROUP BY 2
UNION ALL SELECT 'orders', CAST(o_orderdate AS date), count(*), NULL, round(sum(o_totalprice), 2) FROM orders GROUP BY 2""",
)
def union_all_days(t: Tables) -> DataFrame:
    """Daily rows of two sources with different columns, stacked by name."""
    by_event = t.base("events").groupBy(F.col("ts").cast("date").alias("date")).agg(
        _count("rows"), F.countDistinct("user_id").alias("users")
    )
    by_order = t.base("orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        _count("rows"), F.sum("o_totalprice").alias("total")
    )
    stacked = union_all_by_name(
        [by_event.withColumn("source", F.lit("events")), by_order.withColumn("source", F.lit("orders"))]
    )
    return rounded(stacked, 2, "total")
