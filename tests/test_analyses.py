"""Analyses on small frames with duplicate keys, missing values and one frequent key, against plain SQL joins."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.plans import events, funnel, pages, products, revenue, traffic, users
from eventloom.timing import mark
from tests.conftest import rows

MEDIA = [None, "(none)", "organic", "cpc", "paid social", "referral"]


@pytest.fixture(scope="module")
def data(spark):
    random.seed(11)
    user = lambda: random.choice(["hot", "hot", "hot", "a", "b", "c", None])
    device = lambda: random.choice(["mobile", "desktop", None])
    day = lambda: random.choice(["2024-01-01", "2024-01-02"])
    event_rows = [
        (user(), day(), random.randrange(4), random.choice(["purchase", "view_item", "add_to_cart"]), device(), random.choice([None, 1.5, 2.0]))
        for _ in range(120)
    ]
    session_rows = [(user(), day(), device(), random.choice(MEDIA)) for _ in range(60)]
    urls = ["https://h/a?x=1", "https://h/a", "http://g/b#f", "https://h", "x https://y/z", None]
    param_rows = [
        (user(), random.randrange(5), random.choice(["page_view", "click"]), random.choice(["page_location", "other"]), random.choice(urls))
        for _ in range(120)
    ]
    frames = {
        "events": spark.createDataFrame(
            event_rows,
            "user_pseudo_id string, event_date string, event_timestamp long, event_name string, device_category string,"
            " ecommerce_purchase_revenue_in_usd double",
        ).withColumn("event_date", F.to_date("event_date")),
        "sessions": spark.createDataFrame(
            session_rows, "user_pseudo_id string, event_date string, device_category string, traffic_source_medium string"
        ).withColumn("event_date", F.to_date("event_date")),
        "params": spark.createDataFrame(
            param_rows, "user_pseudo_id string, event_timestamp long, event_name string, key string, param_value string"
        ),
        "categories": spark.createDataFrame(
            [("/a", "one"), ("/a", "two"), ("/a", "two"), ("/b#f", None)], "page_path string, category string"
        ),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(f"small_{name}")
    return frames


def same(df, sql):
    expected = df.sparkSession.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows(df.select(*expected.columns)) == rows(expected) and df.count() > 0


BUYERS = "(SELECT DISTINCT user_pseudo_id, TRUE AS bought FROM small_events WHERE event_name = 'purchase') b"


def test_device_medium_purchases_keeps_the_fan_out(data):
    same(
        traffic.device_medium_purchases(data["events"], data["sessions"]),
        """SELECT s.device_category, s.traffic_source_medium, COUNT(DISTINCT e.user_pseudo_id) AS users,
             COUNT_IF(e.event_name = 'purchase') AS purchases
           FROM small_events e JOIN small_sessions s USING (user_pseudo_id, event_date) GROUP BY 1, 2""",
    )


def test_device_conversion(data):
    same(
        traffic.device_conversion(data["sessions"], data["events"]),
        f"""SELECT *, try_divide(CAST(purchasers AS double), users) AS cvr FROM (
              SELECT device_category, traffic_source_medium, COUNT(DISTINCT s.user_pseudo_id) AS users,
                COUNT_IF(coalesce(bought, false)) AS purchasers
              FROM small_sessions s LEFT JOIN {BUYERS} USING (user_pseudo_id) GROUP BY 1, 2)""",
    )


def test_traffic_channels(data):
    channel = """CASE WHEN traffic_source_medium IS NULL OR traffic_source_medium = '(none)' THEN 'Direct'
      WHEN traffic_source_medium = 'organic' THEN 'Organic Search' WHEN traffic_source_medium = 'cpc' THEN 'Paid Search'
      WHEN traffic_source_medium = 'paid social' THEN 'Social' ELSE 'Referral' END"""
    same(
        traffic.traffic_channels(data["sessions"], data["events"]),
        f"""SELECT *, try_divide(CAST(converters AS double), unique_users) AS cvr, sessions / 60D AS sessions_pct FROM (
              SELECT {channel} AS channel, COUNT(*) AS sessions, COUNT(DISTINCT s.user_pseudo_id) AS unique_users,
                COUNT(bought) AS converters
              FROM small_sessions s LEFT JOIN {BUYERS} USING (user_pseudo_id) GROUP BY 1)""",
    )


def test_distinct_users_never_exceed_one(data):
    for result in (
        traffic.traffic_channels(data["sessions"], data["events"], distinct_users=True),
        traffic.device_conversion(data["sessions"], data["events"], distinct_users=True),
    ):
        assert all(r.cvr is None or r.cvr <= 1 for r in result.collect())
    assert any(r.cvr > 1 for r in traffic.traffic_channels(data["sessions"], data["events"]).collect() if r.cvr is not None)


def test_page_views_by_device_is_many_to_many(data):
    same(
        pages.page_views_by_device(data["params"], data["events"], min_views=1, n=1000),
        r"""SELECT device_category, page_path, COUNT(*) AS page_views, COUNT(DISTINCT user_pseudo_id) AS users FROM (
              SELECT user_pseudo_id, device_category,
                regexp_replace(regexp_replace(param_value, r'\?.*$', ''), r'^(.*?)https?://[^/]+', '$1') AS page_path
              FROM small_params p LEFT JOIN small_events e USING (event_timestamp, user_pseudo_id)
              WHERE key = 'page_location') GROUP BY 1, 2""",
    )


def test_page_category_counts(data):
    same(
        pages.page_category_counts(data["params"], data["categories"]),
        r"""SELECT category, COUNT(*) AS n FROM (
              SELECT regexp_replace(param_value, r'^https?://[^/]+|\?.*$', '') AS page_path
              FROM small_params WHERE key = 'page_location') LEFT JOIN small_categories USING (page_path) GROUP BY 1""",
    )


def test_path_views_agree_with_page_performance(data):
    performance = pages.page_performance(data["params"]).select("section", "page_path", "page_views")
    assert rows(performance) == rows(pages.path_views(data["params"]))
    assert pages.top_pages(data["params"], 2).count() == 2


def test_user_segments(spark, data):
    params = spark.createDataFrame(
        [("hot", "1"), ("hot", "2"), ("hot", "2"), ("a", "1"), ("zz", "x"), ("b", "3")], "user_pseudo_id string, param_value string"
    ).withColumn("key", F.lit("ga_session_number"))
    result = {r.user_type: r for r in users.user_segments(params, data["events"]).collect()}
    assert {t: (r.total_users, r.total_sessions) for t, r in result.items()} == {
        None: (1, 1),
        "New User": (2, 2),
        "Returning User": (2, 2),
    }
    spent = {
        r.user_pseudo_id: r.s or 0.0
        for r in revenue.purchases(data["events"]).groupBy("user_pseudo_id").agg(F.sum(revenue.REVENUE).alias("s")).collect()
    }
    assert result["New User"].total_revenue == spent.get("hot", 0) + spent.get("a", 0)
    assert result[None].total_revenue == 0 and result[None].cvr == 0


def test_event_overview_exact_and_approximate(data):
    exact, approx = events.event_overview(data["events"]), events.event_overview(data["events"], approx=True)
    assert rows(exact) == rows(approx)
    same(
        exact,
        """SELECT event_name, COUNT(*) AS total_events, COUNT(DISTINCT user_pseudo_id) AS unique_users,
             COUNT(DISTINCT event_date) AS unique_days, ROUND(COUNT(*) / CAST(COUNT(DISTINCT event_date) AS double), 1) AS events_per_day
           FROM small_events GROUP BY 1""",
    )


def test_funnels(spark, data):
    got = funnel.funnel_stages(data["events"], ["view_item", "add_to_cart", "purchase", "absent"]).collect()
    assert [r.event_name for r in got] == ["view_item", "add_to_cart", "purchase"]
    assert got[0].pct_prev is None and got[0].drop_off is None and max(r.pct_of_top for r in got) == 1
    by_sql = funnel.funnel_sql(data["events"], ["view_item", "purchase"]).collect()
    assert [r.event_name for r in by_sql] == ["view_item", "purchase"] and by_sql[0].pct_of_top == 100.0


def test_category_rollup(spark):
    items = spark.createDataFrame(
        [("A", "x", 1, 3.0, 1), ("A", "x", 2, 1.0, 1), ("A", "y", 1, 2.0, 2), ("B", "x", 1, 2.0, 3), ("B", None, 9, 9.0, 4), (None, "z", 1, None, 5)],
        "item_category string, item_name string, quantity long, item_revenue_in_usd double, event_timestamp long",
    )
    got = rows(products.category_rollup(items).select("item_category", "products", "revenue", "units", "revenue_pct"))
    assert got == [(None, 1, None, 1, None), ("A", 2, 6.0, 4, 0.75), ("B", 1, 2.0, 1, 0.25)]


def test_mark(spark):
    result = mark({"a": lambda: spark.range(3), "b": lambda: spark.range(4)}, iterations=2, warmup=0)
    assert [r["name"] for r in result] == ["a", "b"] and all(r["min"] <= r["median"] <= r["max"] for r in result)


def test_transactions_by_bitmap_equal_distinct_ones(spark):
    data = [("c", f"p{i % 5}", i % 97, 1.0, 2, 3.0) for i in range(700)]
    data += [(None, "p0", 40_000 + i % 3, 1.0, 1, 1.0) for i in range(20)] + [("c", "none", None, 1.0, 1, 1.0), ("c", None, 5, 1.0, 1, 1.0)]
    data += [("c", "far", t, 1.0, 1, 1.0) for t in (0, 1, 32767, 32768, 32769, 10**15)]
    items = spark.createDataFrame(
        data, "item_category string, item_name string, event_timestamp long, price_in_usd double, quantity long, item_revenue_in_usd double"
    )
    plain = products.product_performance(items)
    assert rows(products.product_performance(items, bitmaps=True)) == rows(plain)
    assert {r.item_name: r.transactions for r in plain.where("item_category = 'c'").collect()}["far"] == 6
