"""The named analyses over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventloom.fixtures import Tables
from eventloom.plans import checkouts, events, funnel, pages, products, revenue, sales, traffic, users
from eventloom.suite.registry import query, rounded


@query(
    "event_overview",
    "ga_events",
    """SELECT event_name, count(*) AS total_events, count(DISTINCT user_pseudo_id) AS unique_users,
  count(DISTINCT event_date) AS unique_days,
  round(CAST(count(*) AS double) / nullif(count(DISTINCT event_date), 0), 1) AS events_per_day
FROM ga_events GROUP BY event_name""",
)
def event_overview(t: Tables) -> DataFrame:
    return events.event_overview(t.events())


@query("event_counts", "ga_events", "SELECT event_name, count(*) AS n FROM ga_events GROUP BY event_name")
def event_counts(t: Tables) -> DataFrame:
    return events.event_counts(t.events())


@query(
    "top_events",
    "ga_events",
    """SELECT event_name, count(*) AS events, count(DISTINCT user_pseudo_id) AS users FROM ga_events
GROUP BY event_name ORDER BY events DESC, event_name LIMIT 10""",
)
def top_events(t: Tables) -> DataFrame:
    return events.top_events(t.events())


@query("daily_events", "ga_events", "SELECT event_date, count(*) AS daily_events FROM ga_events GROUP BY event_date")
def daily_events(t: Tables) -> DataFrame:
    return events.daily_events(t.events())


@query(
    "event_date_users",
    "ga_events",
    """SELECT event_date, event_name, count(DISTINCT user_pseudo_id) AS users FROM ga_events
WHERE event_name IN ('purchase', 'add_to_cart', 'view_item') GROUP BY 1, 2""",
)
def event_date_users(t: Tables) -> DataFrame:
    return events.event_date_users(t.events())


@query(
    "monthly_event_summary",
    "ga_events",
    """SELECT CAST(date_trunc('month', event_date) AS date) AS month, event_name, count(*) AS events,
  count(DISTINCT user_pseudo_id) AS users FROM ga_events
WHERE event_name IN ('page_view', 'purchase', 'add_to_cart') GROUP BY 1, 2""",
)
def monthly_event_summary(t: Tables) -> DataFrame:
    return events.monthly_event_summary(t.events(), ["page_view", "purchase", "add_to_cart"])


@query(
    "device_medium_purchases",
    "ga_events ga_sessions",
    """SELECT s.device_category, s.traffic_source_medium, count(DISTINCT e.user_pseudo_id) AS users,
  CAST(sum(CASE WHEN e.event_name = 'purchase' THEN 1 ELSE 0 END) AS bigint) AS purchases
FROM ga_events e JOIN ga_sessions s ON e.user_pseudo_id = s.user_pseudo_id AND e.event_date = s.event_date
GROUP BY 1, 2""",
)
def device_medium_purchases(t: Tables) -> DataFrame:
    return traffic.device_medium_purchases(t.events(), t.sessions())


_BUYERS = "(SELECT DISTINCT user_pseudo_id, TRUE AS purchased FROM ga_events WHERE event_name = 'purchase') b"


@query(
    "device_conversion",
    "ga_events ga_sessions",
    f"""SELECT device_category, traffic_source_medium, users, purchasers, CAST(purchasers AS double) / users AS cvr
FROM (SELECT device_category, traffic_source_medium, count(DISTINCT s.user_pseudo_id) AS users,
        CAST(sum(CASE WHEN purchased THEN 1 ELSE 0 END) AS bigint) AS purchasers
      FROM ga_sessions s LEFT JOIN {_BUYERS} USING (user_pseudo_id) GROUP BY 1, 2) g""",
)
def device_conversion(t: Tables) -> DataFrame:
    return traffic.device_conversion(t.sessions(), t.events())


@query(
    "traffic_channels",
    "ga_events ga_sessions",
    f"""SELECT channel, sessions, unique_users, converters, CAST(converters AS double) / unique_users AS cvr,
  CAST(sessions AS double) / CAST(sum(sessions) OVER () AS double) AS sessions_pct
FROM (SELECT CASE WHEN traffic_source_medium IS NULL OR traffic_source_medium = '(none)' THEN 'Direct'
          WHEN traffic_source_medium = 'organic' THEN 'Organic Search'
          WHEN traffic_source_medium IN ('cpc', 'ppc') THEN 'Paid Search'
          WHEN traffic_source_medium LIKE '%email%' THEN 'Email' WHEN traffic_source_medium LIKE '%social%' THEN 'Social'
          WHEN traffic_source_medium = 'referral' THEN 'Referral' ELSE '(Data Deleted)' END AS channel,
        count(*) AS sessions, count(DISTINCT s.user_pseudo_id) AS unique_users,
        count(purchased) AS converters
      FROM ga_sessions s LEFT JOIN {_BUYERS} USING (user_pseudo_id) GROUP BY 1) g""",
)
def traffic_channels(t: Tables) -> DataFrame:
    return traffic.traffic_channels(t.sessions(), t.events())


@query(
    "top_pages",
    "sectioned",
    """SELECT section, page_path, count(*) AS page_views, count(DISTINCT user_pseudo_id) AS unique_users
FROM sectioned GROUP BY 1, 2 ORDER BY page_views DESC, section, page_path LIMIT 20""",
)
def top_pages(t: Tables) -> DataFrame:
    return pages.top_pages(t.params())


@query(
    "page_views_by_device",
    "ga_events ga_params",
    r"""SELECT device_category, page_path, count(*) AS page_views, count(DISTINCT user_pseudo_id) AS users
FROM (SELECT e.device_category, p.user_pseudo_id,
        regexp_replace(regexp_replace(p.param_value, '\?.*$', ''), 'https?://[^/]+', '') AS page_path
      FROM ga_params p LEFT JOIN ga_events e ON e.event_ts = p.event_ts AND e.user_pseudo_id = p.user_pseudo_id
      WHERE p.key = 'page_location') x
GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY page_views DESC, device_category NULLS LAST, page_path LIMIT 20""",
)
def page_views_by_device(t: Tables) -> DataFrame:
    return pages.page_views_by_device(t.params(), t.events(), keys=("event_ts", "user_pseudo_id"))


@query(
    "page_view_extract",
    "ga_params",
    """SELECT event_date, user_pseudo_id, param_value FROM ga_params
WHERE event_name = 'page_view' AND key = 'page_location'""",
)
def page_view_extract(t: Tables) -> DataFrame:
    return pages.page_view_extract(t.params())


@query(
    "page_views_per_user",
    "ga_params",
    "SELECT user_pseudo_id, count(*) AS page_views FROM ga_params WHERE event_name = 'page_view' GROUP BY 1",
)
def page_views_per_user(t: Tables) -> DataFrame:
    return pages.page_views_per_user(t.params())


@query(
    "top_locations",
    "ga_params",
    """SELECT param_value, count(*) AS n FROM ga_params WHERE key = 'page_location'
GROUP BY 1 ORDER BY n DESC, param_value LIMIT 10""",
)
def top_locations(t: Tables) -> DataFrame:
    return pages.top_locations(t.params())


_DAILY = """SELECT event_date, count(*) AS transactions, sum(ecommerce_purchase_revenue_in_usd) AS revenue,
  avg(ecommerce_purchase_revenue_in_usd) AS aov, count(DISTINCT user_pseudo_id) AS unique_buyers
FROM ga_events WHERE event_name = 'purchase' GROUP BY event_date"""


@query(
    "daily_revenue",
    "ga_events",
    f"SELECT event_date, transactions, round(revenue, 4) AS revenue, round(aov, 8) AS avg_order_value FROM ({_DAILY}) d",
)
def daily_revenue(t: Tables) -> DataFrame:
    return rounded(rounded(revenue.daily_revenue(t.events()), 4, "revenue"), 8, "avg_order_value")


_ROLLING = f"""SELECT event_date, transactions, round(revenue, 4) AS revenue, round(aov, 8) AS aov, unique_buyers,
  round(avg(revenue) OVER (ORDER BY event_date %s BETWEEN %s AND CURRENT ROW), 8) AS revenue_7day FROM ({_DAILY}) d"""


@query("daily_revenue_7day", "ga_events", _ROLLING % ("ROWS", "6 PRECEDING"))
def daily_revenue_7day(t: Tables) -> DataFrame:
    return rounded(rounded(revenue.daily_revenue_7day(t.events()), 4, "revenue"), 8, "aov", "revenue_7day")


@query("daily_revenue_7days_calendar", "ga_events", _ROLLING % ("RANGE", "INTERVAL 6 DAY PRECEDING"))
def daily_revenue_7days_calendar(t: Tables) -> DataFrame:
    daily = revenue.daily_revenue_7day(t.events(), calendar=True)
    return rounded(rounded(daily, 4, "revenue"), 8, "aov", "revenue_7day")


@query("purchase_by_day", "ga_events", f"SELECT event_date, round(revenue, 4) AS revenue, transactions AS n FROM ({_DAILY}) d")
def purchase_by_day(t: Tables) -> DataFrame:
    return rounded(revenue.purchase_by_day(t.events()), 4, "revenue")


@query(
    "revenue_date_device",
    "ga_events",
    """SELECT event_date, device_category, count(DISTINCT user_pseudo_id) AS users,
  round(sum(ecommerce_purchase_revenue_in_usd), 4) AS revenue
FROM ga_events WHERE event_name = 'purchase' GROUP BY 1, 2""",
)
def revenue_date_device(t: Tables) -> DataFrame:
    return rounded(revenue.revenue_date_device(t.events()), 4, "revenue")


@query(
    "funnel_stages",
    "ga_events",
    """SELECT event_name, users, stage_label, CAST(stage_order AS integer) AS stage_order,
  CAST(users AS double) / max(users) OVER () AS pct_of_top,
  CAST(users AS double) / lag(users) OVER (ORDER BY stage_order) AS pct_prev,
  1 - CAST(users AS double) / lag(users) OVER (ORDER BY stage_order) AS drop_off
FROM (SELECT event_name, count(DISTINCT user_pseudo_id) AS users,
        CASE event_name WHEN 'view_item' THEN 'View Item' WHEN 'add_to_cart' THEN 'Add to Cart'
          WHEN 'begin_checkout' THEN 'Begin Checkout' WHEN 'add_payment_info' THEN 'Add Payment' ELSE 'Purchase' END AS stage_label,
        CASE event_name WHEN 'view_item' THEN 1 WHEN 'add_to_cart' THEN 2 WHEN 'begin_checkout' THEN 3
          WHEN 'add_payment_info' THEN 4 ELSE 5 END AS stage_order
      FROM ga_events WHERE event_name IN ('view_item', 'add_to_cart', 'begin_checkout', 'add_payment_info', 'purchase')
      GROUP BY event_name) f""",
)
def funnel_stages(t: Tables) -> DataFrame:
    return funnel.funnel_stages(t.events())


@query(
    "product_performance",
    "ga_items",
    """SELECT item_category, item_name, CAST(sum(quantity) AS bigint) AS units_sold,
  round(sum(item_revenue_in_usd), 4) AS revenue, count(DISTINCT event_timestamp) AS transactions,
  round(avg(price_in_usd), 8) AS avg_price FROM ga_items WHERE item_name IS NOT NULL GROUP BY 1, 2""",
)
def product_performance(t: Tables) -> DataFrame:
    return rounded(rounded(products.product_performance(t.items()), 4, "revenue"), 8, "avg_price")


@query(
    "category_rollup",
    "ga_items",
    """SELECT item_category, products, round(revenue, 4) AS revenue, units,
  round(revenue / sum(revenue) OVER (), 8) AS revenue_pct
FROM (SELECT item_category, count(DISTINCT item_name) AS products, sum(item_revenue_in_usd) AS revenue,
        CAST(sum(quantity) AS bigint) AS units FROM ga_items WHERE item_name IS NOT NULL GROUP BY 1) g""",
)
def category_rollup(t: Tables) -> DataFrame:
    return rounded(rounded(products.category_rollup(t.items()), 4, "revenue"), 8, "revenue_pct")


@query(
    "top_items_in_category",
    "ga_items",
    """SELECT item_category, item_name, item_id, price_in_usd, quantity, event_timestamp,
  round(item_revenue_in_usd, 4) AS item_revenue_in_usd FROM ga_items WHERE item_category = 'PROMO'
ORDER BY price_in_usd DESC NULLS LAST, item_name, item_id, ga_items.item_revenue_in_usd, quantity, event_timestamp LIMIT 10""",
)
def top_items_in_category(t: Tables) -> DataFrame:
    return rounded(products.top_items_in_category(t.items(), "PROMO"), 4, "item_revenue_in_usd")


@query(
    "user_segments",
    "numbered ga_events",
    """SELECT user_type, count(*) AS total_users, count(purchases) AS buyers,
  CAST(count(purchases) AS double) / count(*) AS cvr, round(sum(coalesce(revenue, 0)), 2) AS total_revenue,
  round(avg(coalesce(revenue, 0)), 8) AS avg_revenue, CAST(sum(sessions) AS bigint) AS total_sessions,
  round(avg(sessions), 8) AS avg_sessions
FROM (SELECT user_pseudo_id, CASE WHEN session_number = 1 THEN 'New User' ELSE 'Returning User' END AS user_type,
        count(DISTINCT session_number) AS sessions FROM numbered GROUP BY 1, 2) u
LEFT JOIN (SELECT user_pseudo_id, count(*) AS purchases, sum(ecommerce_purchase_revenue_in_usd) AS revenue
           FROM ga_events WHERE event_name = 'purchase' GROUP BY 1) p USING (user_pseudo_id)
GROUP BY 1""",
)
def user_segments(t: Tables) -> DataFrame:
    segments = users.user_segments(t.session_start_numbers(), t.events())
    return rounded(rounded(segments, 2, "total_revenue"), 8, "avg_revenue", "avg_sessions")


_SALES = "SELECT %s, round(sum(sales), 2) AS %s FROM sales %s GROUP BY 1"


@query("sales_by_region", "sales", _SALES % ("region", "total_sales", ""))
def sales_by_region(t: Tables) -> DataFrame:
    return rounded(sales.sales_by_region(t.sales()), 2, "total_sales")


@query("sales_by_region_since", "sales", _SALES % ("region", "total_sales", "WHERE sale_year >= 1999"))
def sales_by_region_since(t: Tables) -> DataFrame:
    return rounded(sales.sales_by_region(t.sales(), since=1999), 2, "total_sales")


@query("sales_by_year", "sales", _SALES % ("sale_year AS year", "total", ""))
def sales_by_year(t: Tables) -> DataFrame:
    return rounded(sales.sales_by_year(t.sales()), 2, "total")


@query(
    "electronics_avg_price", "sales", "SELECT round(avg(sales), 6) AS avg_price FROM sales WHERE category = '1-URGENT'"
)
def electronics_avg_price(t: Tables) -> DataFrame:
    return rounded(sales.average_price(t.sales(), "1-URGENT"), 6, "avg_price")


_BY_YEAR = "SELECT CheckoutYear, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts %s GROUP BY 1"


@query("checkouts_by_year", "checkouts", _BY_YEAR % "")
def checkouts_by_year(t: Tables) -> DataFrame:
    return checkouts.checkouts_by_year(t.checkouts())


@query("book_suffix_2020", "checkouts", _BY_YEAR % "WHERE CheckoutYear = 1999 AND MaterialType LIKE '%BOOK'")
def book_suffix_of_year(t: Tables) -> DataFrame:
    return checkouts.checkouts_by_year(t.checkouts(), suffix="BOOK", year=1999)


@query(
    "book_by_month",
    "checkouts",
    """SELECT CheckoutYear, CheckoutMonth, CAST(sum(Checkouts) AS bigint) AS TotalCheckouts FROM checkouts
WHERE CheckoutYear >= 1998 AND MaterialType = 'BOOK' GROUP BY 1, 2""",
)
def book_by_month(t: Tables) -> DataFrame:
    return checkouts.books_by_month(t.checkouts(), since=1998)


@query(
    "book_month_desc",
    "checkouts",
    """SELECT CheckoutMonth, CAST(sum(Checkouts) AS bigint) AS TotalCheckouts FROM checkouts
WHERE CheckoutYear = 2000 AND MaterialType = 'BOOK' GROUP BY 1""",
)
def book_month_desc(t: Tables) -> DataFrame:
    return checkouts.books_of_year(t.checkouts(), 2000)


@query(
    "checkouts_with_total",
    "checkouts",
    """SELECT CheckoutYear, CheckoutMonth, Checkouts, n, CAST(sum(Checkouts) OVER () AS bigint) AS Total_checkouts
FROM (SELECT CheckoutYear, CheckoutMonth, Checkouts, count(*) AS n FROM checkouts GROUP BY 1, 2, 3) g""",
)
def checkouts_with_total(t: Tables) -> DataFrame:
    return checkouts.counts_with_total(t.checkouts())


@query(
    "top_title_per_year",
    "checkouts",
    """SELECT CheckoutYear, Title, checkouts FROM (
  SELECT *, row_number() OVER (PARTITION BY CheckoutYear ORDER BY checkouts DESC, Title) AS rn
  FROM (SELECT CheckoutYear, Title, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts
        WHERE MaterialType LIKE '%BOOK' GROUP BY 1, 2) g) r WHERE rn = 1""",
)
def top_title_per_year(t: Tables) -> DataFrame:
    return checkouts.top_title_per_year(t.checkouts())


@query(
    "top_author",
    "checkouts",
    """SELECT Creator, count(DISTINCT Title) AS titles FROM checkouts
WHERE MaterialType LIKE '%BOOK' AND Creator IS NOT NULL GROUP BY 1 ORDER BY titles DESC, Creator LIMIT 1""",
)
def top_author(t: Tables) -> DataFrame:
    return checkouts.top_authors(t.checkouts())


@query(
    "book_vs_ebook",
    "checkouts",
    """SELECT CheckoutYear, CAST(sum(CASE WHEN MaterialType = 'BOOK' THEN Checkouts END) AS bigint) AS "BOOK",
  CAST(sum(CASE WHEN MaterialType = 'EBOOK' THEN Checkouts END) AS bigint) AS "EBOOK"
FROM checkouts WHERE MaterialType IN ('BOOK', 'EBOOK') GROUP BY 1""",
)
def book_vs_ebook(t: Tables) -> DataFrame:
    return checkouts.material_trend(t.checkouts())
