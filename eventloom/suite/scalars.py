"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom import functions as X
from eventloom.fixtures import Tables
from eventloom.operators import number_sessions
from eventloom.plans import checkouts, pages
from eventloom.suite.registry import query, rounded


@query(
    "book_suffix",
    "checkouts",
    """SELECT CheckoutYear, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts
WHERE MaterialType LIKE '%BOOK' GROUP BY 1""",
)
def book_suffix(t: Tables) -> DataFrame:
    return checkouts.checkouts_by_year(t.checkouts(), suffix="BOOK")


@query(
    "page_sections",
    "sectioned",
    """SELECT section, CAST(sum(n) AS bigint) AS page_views, count(*) AS paths
FROM (SELECT section, page_path, count(*) AS n FROM sectioned GROUP BY 1, 2) g GROUP BY 1""",
)
def page_sections(t: Tables) -> DataFrame:
    return pages.page_sections(t.params())


@query(
    "url_path",
    "",
    r"""SELECT page_id, CASE WHEN p = '' THEN '/' ELSE p END AS page_path
FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^https?://[^/]+', ''), '\?.*$', ''), '#.*$', '') AS p
      FROM pages) x""",
)
def url_path(t: Tables) -> DataFrame:
    return t.base("pages").select("page_id", X.url_path(F.col("url")).alias("page_path"))


@query(
    "url_path_dbplyr",
    "",
    r"""SELECT page_id, regexp_replace(regexp_replace(url, '\?.*$', ''), 'https?://[^/]+', '') AS page_path FROM pages""",
)
def url_path_keep_fragment(t: Tables) -> DataFrame:
    return t.base("pages").select("page_id", X.url_path_keep_fragment(F.col("url")).alias("page_path"))


@query(
    "url_path_all",
    "",
    r"""SELECT page_id, regexp_replace(url, '^https?://[^/]+|\?.*$', '', 'g') AS page_path FROM pages""",
)
def url_path_all(t: Tables) -> DataFrame:
    return t.base("pages").select("page_id", X.url_path_one_pass(F.col("url")).alias("page_path"))


@query(
    "suffix_date",
    "",
    """SELECT strftime(CAST(o_orderdate AS date), '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM customer""",
)
def suffix_date(t: Tables) -> DataFrame:
    """Day cut out of table names; names without eight digits have none."""
    dated = t.base("orders").select(F.concat(F.lit("events_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("name"))
    undated = t.base("customer").select(F.col("c_mktsegment").alias("name"))
    names = dated.unionAll(undated).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return names.groupBy(X.extract_day(F.col("name")).alias("day")).agg(F.sum("n").alias("n"))


@query(
    "channel_title",
    "ga_sessions",
    """SELECT CASE traffic_source_medium WHEN 'organic' THEN 'Organic' WHEN 'cpc' THEN 'Cpc' WHEN 'ppc' THEN 'Ppc'
  WHEN 'email-news' THEN 'Email-News' WHEN 'paid social' THEN 'Paid Social' WHEN '(none)' THEN '(None)'
  WHEN 'referral' THEN 'Referral' WHEN '(data deleted)' THEN '(Data Deleted)' END AS title, count(*) AS n
FROM ga_sessions GROUP BY 1""",
)
def channel_title(t: Tables) -> DataFrame:
    counted = t.sessions().groupBy("traffic_source_medium").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(X.title_case(F.col("traffic_source_medium")).alias("title"), "n")


@query(
    "year_month_from_string",
    "",
    """SELECT CAST(year(o_orderdate) AS integer) AS year, CAST(month(o_orderdate) AS integer) AS month, count(*) AS n
FROM orders GROUP BY 1, 2""",
)
def year_month_from_string(t: Tables) -> DataFrame:
    keyed = t.base("orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("event_date"))
    return X.with_partition_columns(keyed).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "truncate_label",
    "",
    "SELECT page_id, CASE WHEN length(url) > 40 THEN left(url, 37) || '...' ELSE url END AS label FROM pages",
)
def truncate_label(t: Tables) -> DataFrame:
    return t.base("pages").select("page_id", X.truncate_label(F.col("url"), 40).alias("label"))


@query("label_concat", "ga_events", "SELECT '[' || event_name || ']' AS label, count(*) AS n FROM ga_events GROUP BY 1")
def label_concat(t: Tables) -> DataFrame:
    counted = t.events().groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(X.bracket_label(F.col("event_name")).alias("label"), "n")


@query(
    "blank_check",
    "",
    """SELECT lang, count(CASE WHEN text IS NULL OR length(trim(text)) = 0 THEN 1 END) AS blank, count(*) AS n
FROM documents GROUP BY 1""",
)
def blank_check(t: Tables) -> DataFrame:
    return t.base("documents").groupBy("lang").agg(
        F.count_if(X.is_blank(F.col("text"))).alias("blank"), F.count(F.lit(1)).alias("n")
    )


@query(
    "formatted_counts",
    "ga_events",
    """SELECT event_name, format('{:,}', n) AS events, printf('%.2f', n * 100.0 / total) || '%' AS share
FROM (SELECT event_name, count(*) AS n, (SELECT count(*) FROM ga_events) AS total FROM ga_events GROUP BY 1) g""",
)
def formatted_counts(t: Tables) -> DataFrame:
    events = t.events()
    total = events.select(F.count(F.lit(1))).scalar()
    counted = events.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    share = X.safe_divide(F.col("n"), total)
    return counted.select("event_name", X.comma(F.col("n")).alias("events"), X.percent(share, 2).alias("share"))


@query(
    "parse_event_date",
    "",
    """SELECT CASE WHEN event_type <> 'error' THEN CAST(ts AS date) END AS event_date, count(*) AS n
FROM events GROUP BY 1""",
)
def parse_event_date(t: Tables) -> DataFrame:
    """Day keys to dates; the keys of error events are cut short and give NULL."""
    key = F.date_format("ts", "yyyyMMdd")
    key = F.when(F.col("event_type") == "error", F.substring(key, 1, 7)).otherwise(key)
    return t.base("events").groupBy(X.parse_day(key).alias("event_date")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_parts",
    "",
    """SELECT CAST(year(l_shipdate) AS integer) AS year, CAST(month(l_shipdate) AS integer) AS month,
  CAST(day(l_shipdate) AS integer) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def date_parts(t: Tables) -> DataFrame:
    keyed = t.base("lineitem").select(F.date_format("l_shipdate", "yyyyMMdd").alias("event_date"))
    return X.with_date_parts(keyed).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query("event_datetime", "", "SELECT event_id, ts AS event_dt FROM events")
def event_datetime(t: Tables) -> DataFrame:
    """Microseconds back to the time they came from."""
    micros = t.timed_events().select("event_id", "event_timestamp")
    return micros.select("event_id", X.event_time(F.col("event_timestamp")).cast("timestamp_ntz").alias("event_dt"))


@query(
    "channel_group",
    "ga_sessions",
    """SELECT CASE WHEN traffic_source_medium IS NULL OR traffic_source_medium = '(none)' THEN 'Direct'
  WHEN traffic_source_medium = 'organic' THEN 'Organic Search' WHEN traffic_source_medium IN ('cpc', 'ppc') THEN 'Paid Search'
  WHEN traffic_source_medium LIKE '%email%' THEN 'Email' WHEN traffic_source_medium LIKE '%social%' THEN 'Social'
  WHEN traffic_source_medium = 'referral' THEN 'Referral' ELSE '(Data Deleted)' END AS channel, count(*) AS n
FROM ga_sessions GROUP BY 1""",
)
def channel_group(t: Tables) -> DataFrame:
    channel = X.channel_group(F.col("traffic_source_medium")).alias("channel")
    return t.sessions().groupBy(channel).agg(F.count(F.lit(1)).alias("n"))


@query(
    "user_type",
    "numbered",
    """SELECT CASE WHEN session_number = 1 THEN 'New User' ELSE 'Returning User' END AS user_type, count(*) AS events,
  count(DISTINCT user_pseudo_id) AS users FROM numbered GROUP BY 1""",
)
def user_type(t: Tables) -> DataFrame:
    numbers = t.session_numbers().where(F.col("key") == "ga_session_number")
    typed = numbers.withColumn("user_type", X.user_type(F.col("param_value")))
    return typed.groupBy("user_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_pseudo_id").alias("users")
    )


@query("session_number", "numbered", "SELECT event_id, CAST(session_number AS bigint) AS session_number FROM numbered")
def session_number(t: Tables) -> DataFrame:
    return number_sessions(t.timed_events()).select("event_id", "session_number")


@query(
    "number_text_casts",
    "numbered",
    """SELECT event_id, CAST(session_number AS integer) AS as_integer, CAST(session_number AS double) AS as_number,
  CAST(session_number AS varchar) AS as_text FROM numbered""",
)
def number_text_casts(t: Tables) -> DataFrame:
    numbers = t.session_numbers().where(F.col("key") == "ga_session_number")
    text = numbers.select("event_id", F.col("param_value").alias("as_text"))
    return text.select(
        "event_id",
        X.to_integer(F.col("as_text")).alias("as_integer"),
        F.col("as_text").try_cast("double").alias("as_number"),
        "as_text",
    )


@query(
    "dollar_amounts",
    "ga_events",
    """SELECT event_id, '$' || format('{:,.2f}', ecommerce_purchase_revenue_in_usd) AS revenue FROM ga_events
WHERE event_name = 'purchase'""",
)
def dollar_amounts(t: Tables) -> DataFrame:
    bought = t.events().where(F.col("event_name") == "purchase")
    return bought.select("event_id", X.dollar(F.col("ecommerce_purchase_revenue_in_usd")).alias("revenue"))


@query(
    "if_else_null",
    "ga_sessions",
    """SELECT CASE WHEN traffic_source_medium = 'organic' THEN 'free' WHEN traffic_source_medium <> 'organic' THEN 'other' END
  AS kind, count(*) AS n FROM ga_sessions GROUP BY 1""",
)
def if_else_null(t: Tables) -> DataFrame:
    """A missing medium is neither organic nor other."""
    kind = X.if_else(F.col("traffic_source_medium") == "organic", F.lit("free"), F.lit("other")).alias("kind")
    return t.sessions().groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


@query(
    "safe_ratio",
    "ga_events",
    """SELECT event_date, round(sum(ecommerce_purchase_revenue_in_usd)
  / nullif(count(CASE WHEN event_name = 'purchase' THEN 1 END), 0), 4) AS revenue_per_purchase FROM ga_events GROUP BY 1""",
)
def safe_ratio(t: Tables) -> DataFrame:
    """Days without a purchase have a zero denominator and a NULL ratio."""
    daily = t.events().groupBy("event_date").agg(
        F.sum("ecommerce_purchase_revenue_in_usd").alias("revenue"),
        F.count_if(F.col("event_name") == "purchase").alias("purchases"),
    )
    ratio = X.safe_divide(F.col("revenue"), F.col("purchases")).alias("revenue_per_purchase")
    return rounded(daily.select("event_date", ratio), 4, "revenue_per_purchase")
