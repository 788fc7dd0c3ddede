"""Nested events to flat tables, and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.fixtures import Tables
from eventloom.functions import with_partition_columns
from eventloom.operators import (
    flatten_event_params,
    flatten_items,
    flatten_structs,
    params_for_key,
    session_activity,
    user_day_sessions,
)
from eventloom.suite.registry import query

_IDS_SQL = """strftime(event_date, '%Y%m%d') AS event_date, epoch_us(event_ts) AS event_timestamp, event_name,
  CAST(user_pseudo_id AS varchar) AS user_pseudo_id"""


@query(
    "flatten_structs",
    "ga_events ga_sessions",
    f"""SELECT {_IDS_SQL}, e.device_category,
  'NATION_' || (e.user_pseudo_id % 25) AS geo_country, s.traffic_source_medium,
  CAST(NULL AS varchar) AS traffic_source_source, CAST(NULL AS varchar) AS traffic_source_name,
  e.ecommerce_purchase_revenue_in_usd, CAST(year(event_date) AS integer) AS year, CAST(month(event_date) AS integer) AS month,
  CAST(day(event_date) AS integer) AS day, event_ts AS event_dt
FROM ga_events e JOIN ga_sessions s USING (user_pseudo_id, event_date)""",
)
def flat_events(t: Tables) -> DataFrame:
    flat = flatten_structs(t.events_raw())
    return flat.withColumn("event_dt", F.col("event_dt").cast("timestamp_ntz"))


@query(
    "params_long",
    "ga_events",
    f"""SELECT {_IDS_SQL}, k.key,
  CASE k.key WHEN 'event_type' THEN e.event_type WHEN 'k' THEN json_extract_string(e.props, '$.k')
             WHEN 'amount' THEN CAST(e.value AS varchar) END AS param_value
FROM (SELECT g.*, v.event_type, v.props, v.value FROM ga_events g JOIN events v USING (event_id)) e
CROSS JOIN (VALUES ('event_type'), ('k'), ('amount'), ('debug')) k(key)
WHERE e.event_type NOT IN ('error', 'signup')""",
)
def params_long(t: Tables) -> DataFrame:
    return flatten_event_params(t.events_raw())


@query(
    "params_one_key",
    "ga_events",
    f"""SELECT {_IDS_SQL}, 'k' AS key, json_extract_string(props, '$.k') AS param_value,
  CAST(year(event_date) AS integer) AS year, CAST(month(event_date) AS integer) AS month
FROM (SELECT g.*, v.event_type, v.props FROM ga_events g JOIN events v USING (event_id)) e
WHERE event_type NOT IN ('error', 'signup')""",
)
def params_one_key(t: Tables) -> DataFrame:
    return with_partition_columns(params_for_key(t.events_raw(), "k"))


@query(
    "items_flat",
    "",
    """SELECT strftime(l_shipdate, '%Y%m%d') AS event_date, l_orderkey AS event_timestamp,
  CAST(l_suppkey AS varchar) AS user_pseudo_id, CAST(p_partkey AS varchar) AS item_id, p_name AS item_name,
  p_type AS item_category, p_retailprice AS price, p_retailprice AS price_in_usd,
  CASE WHEN part_no = 1 THEN CAST(l_quantity AS bigint) ELSE 0 END AS quantity,
  CASE WHEN part_no = 1 THEN l_extendedprice ELSE 0 END AS item_revenue_in_usd
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (VALUES (1), (2)) v(part_no) ON part_no = 1 OR l_tax = 0
WHERE l_returnflag <> 'R' AND l_linestatus <> 'O'""",
)
def items_flat(t: Tables) -> DataFrame:
    return flatten_items(t.orders_raw())


@query(
    "sessions_built",
    "",
    """SELECT user_pseudo_id, event_date, event_type, device_category, traffic_source_medium
FROM (SELECT user_id AS user_pseudo_id, CAST(ts AS date) AS event_date, event_type,
        CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
        CASE user_id % 9 WHEN 0 THEN 'organic' WHEN 1 THEN 'cpc' WHEN 2 THEN 'ppc' WHEN 3 THEN 'email-news'
          WHEN 4 THEN 'paid social' WHEN 5 THEN '(none)' WHEN 6 THEN 'referral' WHEN 7 THEN '(data deleted)' END
          AS traffic_source_medium,
        row_number() OVER (PARTITION BY user_id, CAST(ts AS date) ORDER BY ts, event_id) AS rn FROM events) x WHERE rn = 1""",
)
def sessions_built(t: Tables) -> DataFrame:
    """One row per user and day with the attributes of the first event, its type included."""
    attributes = ["event_type", "device_category", "traffic_source_medium"]
    return user_day_sessions(t.timed_events(), attributes, order_by=["event_timestamp", "event_id"])


@query(
    "sessionize",
    "gap_sessions",
    """SELECT user_pseudo_id, CAST(session_number AS bigint) AS session_number, epoch_us(first_ts) AS first_us,
  epoch_us(last_ts) AS last_us, n_events AS events FROM gap_sessions""",
)
def sessionize(t: Tables) -> DataFrame:
    return session_activity(t.timed_events())
