"""The star-schema test tables seen as event, session, parameter, item, checkout and sales tables.

``Tables`` derives them with the DataFrame API; ``CTE`` holds the same definitions as SQL for the independent check.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventloom import schemas
from eventloom.functions.text import HOST_PATTERN, before, remove_all
from eventloom.operators.sessions import number_sessions, session_activity
from eventloom.session import fit_to_input, size_in_bytes
from eventloom.sources.days import calendar_of

# Fixed values of the mapping.
DEVICES = ("desktop", "mobile", "tablet")
MEDIUMS = ("organic", "cpc", "ppc", "email-news", "paid social", "(none)", "referral", "(data deleted)")
MATERIALS = {
    "ECONOMY": "BOOK",
    "SMALL": "EBOOK",
    "MEDIUM": "AUDIOBOOK",
    "PROMO": "VIDEODISC",
    "STANDARD": "SOUNDDISC",
}
LANGUAGES = {"en": "English", "de": "German", "fr": "French"}


def _event_name() -> Column:
    kind, value = F.col("event_type"), F.col("value")
    return (
        F.when(kind == "view", "view_item")
        .when((kind == "click") & (value > 50), "add_to_cart")
        .when(kind == "click", "page_view")
        .when((kind == "signup") & (value > 120), "add_payment_info")
        .when((kind == "signup") & (value > 80), "begin_checkout")
        .when((kind == "purchase") & (value > 150), "purchase")
        .otherwise("user_engagement")
    )


def _revenue() -> Column:
    return F.when((F.col("event_type") == "purchase") & (F.col("value") > 150), F.col("value"))


def _device(user: str = "user_id") -> Column:
    return F.get(F.array(*[F.lit(d) for d in DEVICES]), F.pmod(F.col(user), F.lit(len(DEVICES))).cast("int"))


def _medium(user: str = "user_id") -> Column:
    # the last remainder is past the end of the array and gives NULL
    return F.get(F.array(*[F.lit(m) for m in MEDIUMS]), F.pmod(F.col(user), F.lit(len(MEDIUMS) + 1)).cast("int"))


def _micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def _session_entries() -> Column:
    """The number of a session among parameters that must not be taken for it."""
    values = {"ga_session_number": F.col("session_number"), "ga_session_id": F.lit(1), "engaged": F.lit(None)}
    return F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("param_value")) for k, v in values.items()))


_SCHEMAS: WeakKeyDictionary[SparkSession, dict[str, T.StructType]] = WeakKeyDictionary()


class Tables:
    """Logical tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def base(self, name: str) -> DataFrame:
        """One given table. Its schema is looked up in the files once per session."""
        path = f"{self.folder}/{name}.parquet"
        known = _SCHEMAS.setdefault(self.spark, {})
        if path not in known:
            table = self.spark.read.parquet(path)
            fit_to_input(self.spark, size_in_bytes(table))
            known[path] = table.schema
        return self.spark.read.schema(known[path]).parquet(path)

    def events(self) -> DataFrame:
        """Flat events with a typed date and the time as a timestamp."""
        return self.base("events").select(
            "event_id",
            F.col("ts").cast("date").alias("event_date"),
            F.col("ts").alias("event_ts"),
            F.col("user_id").alias("user_pseudo_id"),
            _event_name().alias("event_name"),
            _device().alias("device_category"),
            _revenue().alias("ecommerce_purchase_revenue_in_usd"),
        )

    def sessions(self) -> DataFrame:
        """One row per user and day."""
        user_days = self.base("events").select("user_id", F.col("ts").cast("date").alias("event_date")).distinct()
        return user_days.select(
            F.col("user_id").alias("user_pseudo_id"),
            "event_date",
            _device().alias("device_category"),
            _medium().alias("traffic_source_medium"),
        )

    def timed_events(self) -> DataFrame:
        """Events with the microsecond timestamp the session operators work on."""
        return self.base("events").select(
            "event_id",
            F.col("user_id").alias("user_pseudo_id"),
            _micros().alias("event_timestamp"),
            F.col("ts").cast("date").alias("event_date"),
            "event_type",
            _device().alias("device_category"),
            _medium().alias("traffic_source_medium"),
        )

    def paged_events(self) -> DataFrame:
        """Raw events, each with the URL of a page."""
        pages = self.base("pages").select("page_id", "url")
        number_of_pages = pages.select(F.count(F.lit(1))).scalar()
        events = self.base("events").withColumn("page_id", F.pmod(F.col("event_id"), number_of_pages))
        return events.join(pages, "page_id")

    def params(self) -> DataFrame:
        """Parameter table with three parameters per event, one of them NULL and one NULL now and then."""
        location = F.when(F.col("event_id") % 11 != 0, F.col("url"))
        values = {"page_location": location, "ga_session_number": F.lit("1"), "page_title": F.lit(None).cast("string")}
        entries = [F.struct(F.lit(k).alias("key"), v.alias("param_value")) for k, v in values.items()]
        return self.paged_events().select(
            "event_id",
            F.col("ts").cast("date").alias("event_date"),
            F.col("ts").alias("event_ts"),
            F.when(F.col("event_type") == "view", "page_view").otherwise(F.col("event_type")).alias("event_name"),
            F.col("user_id").alias("user_pseudo_id"),
            F.inline(F.array(*entries)),
        )

    def session_numbers(self) -> DataFrame:
        """Parameter rows holding the number of the session an event belongs to."""
        return number_sessions(self.timed_events().select("event_id", "user_pseudo_id", "event_timestamp")).select(
            "user_pseudo_id",
            "event_id",
            F.inline(_session_entries()),
        )

    def session_start_numbers(self) -> DataFrame:
        """Parameter rows holding the session number, one per session."""
        sessions = session_activity(self.timed_events().select("user_pseudo_id", "event_timestamp"))
        return sessions.select(
            "user_pseudo_id",
            F.inline(_session_entries()),
        )

    def items(self) -> DataFrame:
        lines = self.base("lineitem").join(self.base("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.col("l_orderkey").alias("event_timestamp"),
            F.col("p_partkey").alias("item_id"),
            F.when(F.col("p_partkey") % 17 != 0, F.col("p_name")).alias("item_name"),
            F.col("p_type").alias("item_category"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.col("p_retailprice").alias("price_in_usd"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("item_revenue_in_usd"),
        )

    def page_categories(self) -> DataFrame:
        """Lookup from path to category. Paths of one language are missing; a path may have two categories."""
        path = before(before(remove_all(F.col("url"), HOST_PATTERN), "?"), "#")
        category = F.when(F.col("url").startswith("https"), "Secure").otherwise("Plain")
        listed = self.base("pages").where(~F.col("url").contains("/es/"))
        return listed.select(path.alias("page_path"), category.alias("category")).distinct()

    def checkouts(self) -> DataFrame:
        material = F.lit("MIXED")
        for kind, name in MATERIALS.items():
            material = F.when(F.col("p_type") == kind, name).otherwise(material)
        lines = self.base("lineitem").join(self.base("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            material.alias("MaterialType"),
            F.year("l_shipdate").alias("CheckoutYear"),
            F.month("l_shipdate").alias("CheckoutMonth"),
            F.col("l_quantity").cast("long").alias("Checkouts"),
            F.col("p_name").alias("Title"),
            F.col("p_brand").alias("Creator"),
        )

    def sales(self) -> DataFrame:
        orders = self.base("orders").join(self.base("customer"), F.col("o_custkey") == F.col("c_custkey"))
        orders = orders.join(self.base("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        orders = orders.join(self.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return orders.select(
            F.col("r_name").alias("region"),
            F.year("o_orderdate").alias("year"),
            F.col("o_totalprice").alias("sales"),
            F.col("o_totalprice").alias("revenue"),
            F.col("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("category"),
        )

    def events_raw(self) -> DataFrame:
        """Nested event rows: typed parameters, structs, and one struct inside a struct.

        ``error`` events have an empty parameter array and ``signup`` events none at all.
        """

        def param(key: str, kind: str | None, value: Column | None) -> Column:
            fields = {f.name: F.lit(None).cast(f.dataType) for f in schemas.PARAM_VALUE}
            if kind is not None:
                fields[kind] = value
            return F.struct(
                F.lit(key).alias("key"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("value")
            )

        filled = F.array(
            param("event_type", "string_value", F.col("event_type")),
            param("k", "int_value", F.get_json_object("props", "$.k").try_cast("long")),
            param("amount", "double_value", F.col("value")),
            param("debug", None, None),
        )
        array_type = schemas.EVENTS_RAW["event_params"].dataType
        params = F.when(F.col("event_type") == "error", F.array().cast(array_type)).when(
            F.col("event_type") != "signup", filled
        )
        user = F.col("user_id")
        empty = F.lit(None)
        bought = [
            F.struct(F.col("event_id").cast("string"), F.lit(name), empty, F.col("value"), F.col("value"), F.lit(n), F.col("value"))
            for n, name in ((1, "first"), (2, None))
        ]
        return self.base("events").select(
            F.date_format("ts", "yyyyMMdd").alias("event_date"),
            _micros().alias("event_timestamp"),
            _event_name().alias("event_name"),
            params.cast(array_type).alias("event_params"),
            user.cast("string").alias("user_pseudo_id"),
            F.struct(
                _device().alias("category"),
                F.struct(F.lit("browser").alias("browser"), F.lit("1").alias("browser_version")).alias("web_info"),
            ).alias("device"),
            F.struct(F.concat(F.lit("NATION_"), F.pmod(user, F.lit(25)).cast("string")).alias("country")).alias("geo"),
            F.struct(
                _medium().alias("medium"),
                F.lit(None).cast("string").alias("source"),
                F.lit(None).cast("string").alias("name"),
            ).alias("traffic_source"),
            F.struct(_revenue().alias("purchase_revenue_in_usd")).alias("ecommerce"),
            F.when(_event_name() == "purchase", F.slice(F.array(*bought), 1, 1 + F.col("event_id").cast("int") % 2))
            .cast(schemas.EVENTS_RAW["items"].dataType)
            .alias("items"),
        )

    def orders_raw(self) -> DataFrame:
        """Nested order events with items. Returned lines are no purchases; open lines have no items array.

        A fully discounted look at the same part is appended as a second item where the tax is zero.
        """

        def item(quantity: Column, revenue: Column) -> Column:
            values = {
                "item_id": F.col("p_partkey").cast("string"),
                "item_name": F.col("p_name"),
                "item_category": F.col("p_type"),
                "price": F.col("p_retailprice"),
                "price_in_usd": F.col("p_retailprice"),
                "quantity": quantity,
                "item_revenue_in_usd": revenue,
            }
            return F.struct(*[column.alias(name) for name, column in values.items()])

        sold = item(F.col("l_quantity").cast("long"), F.col("l_extendedprice"))
        sample = item(F.lit(0).cast("long"), F.lit(0.0))
        bought = F.when(F.col("l_tax") == 0, F.array(sold, sample)).otherwise(F.array(sold))
        lines = self.base("lineitem").join(self.base("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.date_format("l_shipdate", "yyyyMMdd").alias("event_date"),
            F.col("l_orderkey").alias("event_timestamp"),
            F.when(F.col("l_returnflag") == "R", "refund").otherwise("purchase").alias("event_name"),
            F.col("l_suppkey").cast("string").alias("user_pseudo_id"),
            F.when(F.col("l_linestatus") != "O", bought).alias("items"),
        )

    def order_days(self) -> DataFrame:
        """Ingest log over the calendar of the orders: days with orders succeeded, days without one failed."""
        dated = self.base("orders").select(F.col("o_orderdate").cast("date").alias("date"))
        sizes = dated.groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
        days = calendar_of(dated, "date").join(sizes, "date", "left")
        return days.select(
            F.concat(F.lit("events_"), "day").alias("day"),
            F.when(F.col("rows").isNull(), "error").otherwise("success").alias("status"),
            "rows",
        )


_EVENT_NAME_SQL = """CASE WHEN event_type = 'view' THEN 'view_item'
       WHEN event_type = 'click' AND value > 50 THEN 'add_to_cart'
       WHEN event_type = 'click' THEN 'page_view'
       WHEN event_type = 'signup' AND value > 120 THEN 'add_payment_info'
       WHEN event_type = 'signup' AND value > 80 THEN 'begin_checkout'
       WHEN event_type = 'purchase' AND value > 150 THEN 'purchase'
       ELSE 'user_engagement' END"""
_DEVICE_SQL = "CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END"
_MEDIUM_SQL = """CASE user_id % 9 WHEN 0 THEN 'organic' WHEN 1 THEN 'cpc' WHEN 2 THEN 'ppc'
       WHEN 3 THEN 'email-news' WHEN 4 THEN 'paid social' WHEN 5 THEN '(none)' WHEN 6 THEN 'referral'
       WHEN 7 THEN '(data deleted)' END"""
_PATH_SQL = r"""regexp_replace(regexp_replace(regexp_replace({0}, '^https?://[^/]+', ''), '\?.*$', ''), '#.*$', '')"""

CTE = {
    "ga_events": f"""SELECT event_id, CAST(ts AS date) AS event_date, ts AS event_ts, user_id AS user_pseudo_id,
  {_EVENT_NAME_SQL} AS event_name, {_DEVICE_SQL} AS device_category,
  CASE WHEN event_type = 'purchase' AND value > 150 THEN value END AS ecommerce_purchase_revenue_in_usd
FROM events""",
    "ga_sessions": f"""SELECT DISTINCT user_id AS user_pseudo_id, CAST(ts AS date) AS event_date,
  {_DEVICE_SQL} AS device_category, {_MEDIUM_SQL} AS traffic_source_medium
FROM events""",
    "ga_params": """SELECT e.event_id, CAST(e.ts AS date) AS event_date, e.ts AS event_ts,
  CASE WHEN e.event_type = 'view' THEN 'page_view' ELSE e.event_type END AS event_name,
  e.user_id AS user_pseudo_id, k.key, CASE WHEN k.key = 'ga_session_number' THEN '1'
    WHEN k.key = 'page_location' AND e.event_id % 11 <> 0 THEN p.url END AS param_value
FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT COUNT(*) FROM pages)
CROSS JOIN (VALUES ('page_location'), ('ga_session_number'), ('page_title')) AS k(key)""",
    "page_views": f"""SELECT *, CASE WHEN p0 = '' THEN '/' ELSE p0 END AS page_path
FROM (SELECT *, {_PATH_SQL.format("param_value")} AS p0 FROM ga_params
      WHERE key = 'page_location' AND event_name = 'page_view' AND param_value IS NOT NULL) t""",
    "sectioned": r"""SELECT *, CASE WHEN page_path = '/' THEN 'Home'
       WHEN regexp_matches(page_path, '^/google\+re|/store') THEN 'Store'
       WHEN regexp_matches(page_path, '^/product') THEN 'Products'
       WHEN regexp_matches(page_path, '^/basket|/cart') THEN 'Cart'
       WHEN regexp_matches(page_path, '^/checkout') THEN 'Checkout' ELSE 'Other' END AS section
FROM page_views""",
    "numbered": f"""SELECT event_id, user_pseudo_id, event_ts, device_category, traffic_source_medium,
  SUM(is_new) OVER (PARTITION BY user_pseudo_id ORDER BY event_ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_number
FROM (SELECT user_id AS user_pseudo_id, event_id, ts AS event_ts,
        {_DEVICE_SQL} AS device_category, {_MEDIUM_SQL} AS traffic_source_medium,
        CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
               OR ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL '30' MINUTE
             THEN 1 ELSE 0 END AS is_new
      FROM events) t""",
    "gap_sessions": """SELECT user_pseudo_id, session_number, min(device_category) AS device_category,
  min(event_ts) AS first_ts, max(event_ts) AS last_ts, count(*) AS n_events,
  (epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1000000.0 AS duration_s
FROM numbered GROUP BY user_pseudo_id, session_number""",
    "ga_items": """SELECT l_orderkey AS event_timestamp, p_partkey AS item_id,
  CASE WHEN p_partkey % 17 <> 0 THEN p_name END AS item_name, p_type AS item_category, CAST(l_quantity AS bigint) AS quantity, p_retailprice AS price_in_usd,
  l_extendedprice * (1 - l_discount) AS item_revenue_in_usd
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "page_categories": f"""SELECT DISTINCT {_PATH_SQL.format("url")} AS page_path,
  CASE WHEN url LIKE 'https%' THEN 'Secure' ELSE 'Plain' END AS category
FROM pages WHERE url NOT LIKE '%/es/%'""",
    "checkouts": """SELECT CASE p_type WHEN 'ECONOMY' THEN 'BOOK' WHEN 'SMALL' THEN 'EBOOK' WHEN 'MEDIUM' THEN 'AUDIOBOOK'
         WHEN 'PROMO' THEN 'VIDEODISC' WHEN 'STANDARD' THEN 'SOUNDDISC' ELSE 'MIXED' END AS MaterialType,
  CAST(year(l_shipdate) AS integer) AS CheckoutYear, CAST(month(l_shipdate) AS integer) AS CheckoutMonth,
  CAST(l_quantity AS bigint) AS Checkouts, p_name AS Title, p_brand AS Creator
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "sales": """SELECT r_name AS region, CAST(year(o_orderdate) AS integer) AS sale_year, o_totalprice AS sales,
  o_orderpriority AS category
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "order_days": """SELECT 'events_' || strftime(d.date, '%Y%m%d') AS day, s.n AS rows, d.date AS date,
  CASE WHEN s.n IS NULL THEN 'error' ELSE 'success' END AS status
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS date
      FROM (SELECT CAST(min(o_orderdate) AS date) AS lo, CAST(max(o_orderdate) AS date) AS hi FROM orders)) d
LEFT JOIN (SELECT CAST(o_orderdate AS date) AS date, count(*) AS n FROM orders GROUP BY 1) s ON s.date = d.date""",
}

_NEEDS = {
    "page_views": ["ga_params"],
    "sectioned": ["page_views"],
    "gap_sessions": ["numbered"],
}


def with_ctes(names: str, body: str) -> str:
    """Prefix ``body`` with the definitions of the given logical tables and of those they build on."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    if not wanted:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTE[name]})" for name in wanted) + "\n" + body
