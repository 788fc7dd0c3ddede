"""Sources, sinks, day ranges and incremental ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from eventloom import schemas
from eventloom.fixtures import Tables
from eventloom.operators.sessions import user_day_sessions
from eventloom.plans import checkouts, pages, quality, reach, sales, traffic
from eventloom.sources import (
    folder_files,
    day_plan,
    convert,
    read_csv,
    read_day_range,
    read_file_list,
    read_glob,
    read_json,
    read_orc,
    read_parquet,
    read_partitioned,
    union_all_by_name,
    write_parquet,
    write_partitioned,
)
from eventloom.sources.clustering import write_curved
from eventloom.sources.compaction import Bounds, files_of, misfits
from eventloom.sources.days import calendar_of
from eventloom.streaming import DailyIngest
from eventloom.suite import analyses  # noqa: F401 - its SQL is used here too
from eventloom.suite.registry import ORACLE, file_copy, query, rounded
from eventloom.workspace import new_folder, stage

CHECKOUT_COLUMNS = ("MaterialType", "CheckoutYear", "CheckoutMonth", "Checkouts", "Title", "ISBN", "Creator")
CHECKOUT_SCHEMA = T.StructType([schemas.CHECKOUTS[name] for name in CHECKOUT_COLUMNS])
SALES_SCHEMA = T.StructType([schemas.SALES[name] for name in ("region", "category", "year", "sales")])
DAILY_SQL = "SELECT event_date, count(*) AS events FROM ga_events GROUP BY event_date"


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@query(
    "scan_csv",
    "checkouts",
    "SELECT CAST(CheckoutYear AS bigint) AS CheckoutYear, CAST(sum(Checkouts) AS bigint) AS checkouts "
    "FROM checkouts GROUP BY 1",
)
def scan_csv(t: Tables) -> DataFrame:
    return checkouts.checkouts_by_year(read_csv(t.spark, file_copy(t, "checkouts_csv"), CHECKOUT_SCHEMA))


@query("scan_parquet", "", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def scan_parquet(t: Tables) -> DataFrame:
    events = read_parquet(t.spark, f"{t.folder}/events.parquet")
    grouped = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(grouped, 4, "total")


@query("scan_columns", "", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_columns(t: Tables) -> DataFrame:
    return read_parquet(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query("scan_file_list", "ga_events", DAILY_SQL)
def scan_file_list(t: Tables) -> DataFrame:
    return _per_day(read_file_list(t.spark, file_copy(t, "events_by_day"), r"^day=\d{8}$"))


@query("scan_glob", "ga_events", DAILY_SQL)
def scan_glob(t: Tables) -> DataFrame:
    return _per_day(read_glob(t.spark, f"{file_copy(t, 'events_by_day')}/day=*"))


@query(
    "union_by_name",
    "",
    """SELECT CAST(year(o_orderdate) AS integer) AS year, round(sum(o_totalprice), 2) AS total,
  count(CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderpriority END) AS with_category
FROM orders GROUP BY 1""",
)
def union_by_name(t: Tables) -> DataFrame:
    """Two generations of files with different columns in different order."""
    orders = t.base("orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("revenue"), F.col("o_orderpriority").alias("category")
    )
    folder = new_folder(t.spark, "sales-generations")
    write_parquet(orders.where("year < 1998").select("year", "revenue"), f"{folder}/old")
    write_parquet(orders.where("year >= 1998").select("category", "revenue", "year"), f"{folder}/new")
    both = read_glob(t.spark, f"{folder}/*", merge_schema=True)
    grouped = both.groupBy("year").agg(F.sum("revenue").alias("total"), F.count("category").alias("with_category"))
    return rounded(grouped, 2, "total")


@query(
    "scan_partitioned",
    "checkouts",
    "SELECT CheckoutYear, CheckoutMonth, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts GROUP BY 1, 2",
)
def scan_partitioned(t: Tables) -> DataFrame:
    df = read_partitioned(t.spark, file_copy(t, "checkouts_by_year"))
    return df.groupBy("CheckoutYear", "CheckoutMonth").agg(F.sum("Checkouts").alias("checkouts"))


@query(
    "partition_filter",
    "checkouts",
    "SELECT CheckoutMonth, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts WHERE CheckoutYear = 2000 GROUP BY 1",
)
def partition_filter(t: Tables) -> DataFrame:
    df = read_partitioned(t.spark, file_copy(t, "checkouts_by_year")).where(F.col("CheckoutYear") == 2000)
    return df.groupBy("CheckoutMonth").agg(F.sum("Checkouts").alias("checkouts"))


_SALES_SQL = "SELECT region, round(sum(sales), 2) AS total_sales FROM sales GROUP BY region"


@query("scan_json", "sales", _SALES_SQL)
def scan_json(t: Tables) -> DataFrame:
    df = read_json(t.spark, file_copy(t, "sales_json"), SALES_SCHEMA)
    return rounded(sales.sales_by_region(df), 2, "total_sales")


@query("scan_orc", "sales", _SALES_SQL)
def scan_orc(t: Tables) -> DataFrame:
    return rounded(sales.sales_by_region(read_orc(t.spark, file_copy(t, "sales_orc"))), 2, "total_sales")


@query(
    "roundtrip_partitioned",
    "checkouts",
    """SELECT CheckoutYear, count(*) AS n, count(DISTINCT Title) AS titles, CAST(sum(Checkouts) AS bigint) AS checkouts
FROM checkouts GROUP BY 1""",
)
def roundtrip_partitioned(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "roundtrip")
    write_partitioned(t.checkouts(), folder, ["CheckoutYear"])
    return read_partitioned(t.spark, folder).groupBy("CheckoutYear").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("Title").alias("titles"), F.sum("Checkouts").alias("checkouts")
    )


@query(
    "roundtrip_year_month",
    "",
    """SELECT CAST(year(o_orderdate) AS integer) AS year, CAST(month(o_orderdate) AS integer) AS month, count(*) AS n,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""",
)
def roundtrip_year_month(t: Tables) -> DataFrame:
    orders = t.base("orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderkey", "o_totalprice"
    )
    folder = new_folder(t.spark, "roundtrip")
    write_partitioned(orders, folder, ["year", "month"], max_rows_per_file=500_000)
    grouped = read_partitioned(t.spark, folder).groupBy("year", "month")
    return rounded(grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2, "total")


@query(
    "layout_check",
    "",
    """SELECT folder, count(*) AS n_files, count(*) FILTER (length < 20971520) AS too_small,
  count(*) FILTER (length > 2147483648) AS too_large, CAST(sum(length) AS bigint) AS bytes,
  CASE WHEN count(*) >= 10000 THEN 'too many files: partition by fewer columns or rebalance'
    WHEN count(*) FILTER (length > 2147483648) > 0 THEN 'large files: limit the rows per file'
    WHEN count(*) FILTER (length < 20971520) > 0 AND count(*) > 1 THEN 'small files: rebalance before writing' ELSE 'ok' END AS advice
FROM (SELECT source AS folder, n_chars * 20000 AS length FROM documents) f GROUP BY folder""",
)
def layout_check(t: Tables) -> DataFrame:
    """Advice on file sizes, over a size table as wide as real listings are."""
    sizes = t.base("documents").select(
        F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("path"), (F.col("n_chars") * 20000).alias("length")
    )
    return quality.layout_check(sizes)


@query(
    "file_counts",
    "",
    """SELECT 'years' AS description, count(DISTINCT year(l_shipdate)) AS n_files,
  count(DISTINCT year(l_shipdate)) || ' files' AS status FROM lineitem
UNION ALL SELECT 'absent', 0, 'folder missing'""",
)
def file_counts(t: Tables) -> DataFrame:
    """Files per folder: a copy with one file per year, and a folder that is not there."""
    years = file_copy(t, "checkouts_by_year")
    folders = {years: "years", f"{years}-absent": "absent"}
    counted = quality.file_counts(t.spark, folders, expected=1)
    return counted.select("description", "n_files", "status")


@query(
    "storage_summary",
    "",
    """SELECT folder, n_files, true AS size_fits FROM (SELECT 'years' AS folder, count(DISTINCT year(l_shipdate)) AS n_files FROM lineitem) y
UNION ALL SELECT 'total', count(DISTINCT year(l_shipdate)), true FROM lineitem""",
)
def storage_summary(t: Tables) -> DataFrame:
    """Files per folder and over all; sizes depend on the writer and are held against the files' own."""
    years = file_copy(t, "checkouts_by_year")
    summary = quality.storage_summary(t.spark, [years])
    length = folder_files(t.spark, years).agg(F.sum("length").cast("double")).scalar()
    mb, gb = F.round(length / quality.MEGABYTE, 1), F.round(length / (1024 * quality.MEGABYTE), 2)
    fits = (length > 0) & (F.col("size_mb") == mb) & (F.col("size_gb") == gb)
    return summary.select(F.when(F.col("folder") == "total", "total").otherwise("years").alias("folder"), "n_files", fits.alias("size_fits"))


CODECS = ("snappy", "gzip", "zstd", "lz4", "none")


@query(
    "roundtrip_codecs",
    "",
    " UNION ALL ".join(
        f"SELECT '{c}' AS codec, count(*) AS n, CAST(sum(event_id) AS bigint) AS ids FROM events" for c in CODECS
    ),
)
def roundtrip_codecs(t: Tables) -> DataFrame:
    """The same table written with each codec and read back."""
    root, parts = new_folder(t.spark, "codecs"), []
    for codec in CODECS:
        write_parquet(t.base("events").select("event_id"), f"{root}/{codec}", compression=codec)
        back = read_parquet(t.spark, f"{root}/{codec}")
        parts.append(back.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")).select(F.lit(codec).alias("codec"), "n", "ids"))
    return union_all_by_name(parts)


@query(
    "csv_to_parquet",
    "checkouts",
    "SELECT MaterialType, count(*) AS n, CAST(sum(Checkouts) AS bigint) AS checkouts FROM checkouts GROUP BY 1",
)
def csv_to_parquet(t: Tables) -> DataFrame:
    """A CSV converted to Parquet, read from there."""
    folder = new_folder(t.spark, "converted")
    convert(read_csv(t.spark, file_copy(t, "checkouts_csv"), CHECKOUT_SCHEMA), folder)
    return read_parquet(t.spark, folder).groupBy("MaterialType").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Checkouts").alias("checkouts")
    )


@query(
    "scan_day_range",
    "ga_events",
    DAILY_SQL.replace("GROUP", "WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP"),
)
def scan_day_range(t: Tables) -> DataFrame:
    """A range of days; a folder of unfinished rows of one of them lies next to it and is not read."""
    root = file_copy(t, "days_and_intraday")
    return _per_day(read_day_range(t.spark, root, dt.date(2024, 1, 8), dt.date(2024, 1, 14), prefix="day="))


@query(
    "missing_days",
    "ga_events",
    """SELECT d AS date, strftime(d, '%Y%m%d') AS day
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d
      FROM (SELECT min(event_date) AS lo, max(event_date) AS hi FROM ga_events)) c
WHERE d NOT IN (SELECT event_date FROM ga_events WHERE event_name = 'purchase')""",
)
def missing_days(t: Tables) -> DataFrame:
    """Calendar days on which nothing was bought."""
    events = t.events()
    bought = events.where(F.col("event_name") == "purchase").select("event_date").distinct()
    available = bought.select(F.date_format("event_date", "yyyyMMdd").alias("day"))
    return day_plan(calendar_of(events, "event_date"), available)[1]


@query("still_needed_days", "order_days", "SELECT day, date FROM order_days WHERE status = 'error'")
def still_needed_days(t: Tables) -> DataFrame:
    orders = t.base("orders").select(F.col("o_orderdate").cast("date").alias("date"))
    requested = calendar_of(orders, "date").withColumn("day", F.concat(F.lit("events_"), "day"))
    return quality.still_needed(requested, t.order_days())


@query(
    "page_category_counts",
    "ga_params page_categories",
    r"""SELECT category, count(*) AS n
FROM (SELECT regexp_replace(param_value, '^https?://[^/]+|\?.*$', '', 'g') AS page_path FROM ga_params
      WHERE key = 'page_location') p
LEFT JOIN page_categories c USING (page_path) GROUP BY category""",
)
def page_category_counts(t: Tables) -> DataFrame:
    return pages.page_category_counts(t.params(), t.page_categories())


def _ingested(t: Tables) -> DailyIngest:
    """The raw events written by day and ingested once."""
    raw, target = new_folder(t.spark, "raw"), new_folder(t.spark, "ingested")
    write_partitioned(t.events_raw().withColumn("day", F.col("event_date")), raw, ["day"])
    ingest = DailyIngest(t.spark, raw, target, prefix="day=")
    ingest.run()
    return ingest


@query(
    "streaming_ingest",
    "ga_events",
    """SELECT strftime(event_date, '%Y%m%d') AS event_date, count(*) AS events,
  4 * count(CASE WHEN event_type NOT IN ('error', 'signup') THEN 1 END) AS params,
  round(sum(ecommerce_purchase_revenue_in_usd), 2) AS revenue,
  CAST(sum(1 + event_id % 2) FILTER (event_name = 'purchase') AS BIGINT) AS items,
  NULLIF(count(*) FILTER (event_name = 'purchase'), 0) AS named_items,
  round(sum((1 + event_id % 2) * ecommerce_purchase_revenue_in_usd) FILTER (event_name = 'purchase'), 2) AS item_revenue
FROM ga_events JOIN (SELECT event_id, event_type FROM events) k USING (event_id) GROUP BY 1""",
)
def streaming_ingest(t: Tables) -> DataFrame:
    """Nested day files through the incremental ingest; a second run must not add anything."""
    ingest = _ingested(t)
    ingest.run()
    events = ingest.table("events").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.sum("ecommerce_purchase_revenue_in_usd").alias("revenue")
    )
    params = ingest.table("params").groupBy("event_date").agg(F.count(F.lit(1)).alias("params"))
    items = ingest.table("items").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("items"),
        F.count("item_name").alias("named_items"),
        F.sum("item_revenue_in_usd").alias("item_revenue"),
    )
    both = events.join(params, "event_date", "left").join(items, "event_date", "left")
    return rounded(both, 2, "revenue", "item_revenue")


@query("ingested_channels", "", ORACLE["traffic_channels"])
def ingested_channels(t: Tables) -> DataFrame:
    """Raw days, ingest, sessions from the ingested events, channels: the whole way, against the SQL on the base tables."""
    events = _ingested(t).table("events")
    return traffic.traffic_channels(user_day_sessions(events), events)


@query(
    "compacted_layout",
    "ga_events",
    """SELECT strftime(event_date, '%Y%m%d') AS event_date, count(*) AS events,
  round(sum(ecommerce_purchase_revenue_in_usd), 2) AS revenue, true AS fewer_files, CAST(0 AS BIGINT) AS out_of_bounds
FROM ga_events GROUP BY 1""",
)
def compacted_layout(t: Tables) -> DataFrame:
    """Days written in many small files, compacted: the same rows in fewer files, none out of bounds but a day's last."""
    raw, target = new_folder(t.spark, "raw"), new_folder(t.spark, "ingested")
    write_partitioned(t.events_raw().withColumn("day", F.col("event_date")), raw, ["day"])
    ingest = DailyIngest(t.spark, raw, target, prefix="day=", max_rows_per_file=8)
    ingest.run()
    before = files_of(ingest.table("events"), "event_date").groupBy("part").agg(F.count(F.lit(1)).alias("files"))
    before = stage(before, "files-before")
    bounds = Bounds(smallest=24 * 1024, largest=1024 * 1024)
    ingest.compact(bounds)
    events = ingest.table("events")
    after = misfits(files_of(events, "event_date"), bounds).join(before, "part")
    days = events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.sum("ecommerce_purchase_revenue_in_usd").alias("revenue")
    )
    fewer = (F.col("n_files") < F.col("files")) | (F.col("files") == 1)
    checked = days.join(after, F.col("event_date") == F.col("part")).select(
        "event_date", "events", "revenue", fewer.alias("fewer_files"), (F.col("too_small") + F.col("too_large")).alias("out_of_bounds")
    )
    return rounded(checked, 2, "revenue")


@query(
    "point_lookup",
    "ga_events",
    """SELECT event_name, user_pseudo_id, event_date, count(*) AS n, round(sum(ecommerce_purchase_revenue_in_usd), 2) AS revenue
FROM ga_events WHERE event_name = 'purchase' AND event_date = (SELECT min(event_date) FROM ga_events WHERE event_name = 'purchase')
  AND user_pseudo_id <= (SELECT user_pseudo_id FROM ga_events WHERE event_name = 'purchase' ORDER BY event_date, user_pseudo_id LIMIT 1)
GROUP BY ALL""",
)
def point_lookup(t: Tables) -> DataFrame:
    """Files along a curve through name, user and day, then a filter on all three: the least buyer of the first day."""
    path = new_folder(t.spark, "curved")
    columns = ["event_name", "user_pseudo_id", "event_date"]
    write_curved(t.events(), path, columns, bloom_columns=["user_pseudo_id"])
    events = t.spark.read.parquet(path)
    bought = events.where(F.col("event_name") == "purchase")
    first = bought.agg(F.min(F.struct("event_date", "user_pseudo_id"))).first()[0]
    if first is None:
        found = bought.limit(0)
    else:
        found = bought.where((F.col("event_date") == F.lit(first[0])) & (F.col("user_pseudo_id") <= F.lit(first[1])))
    sums = found.groupBy("event_name", "user_pseudo_id", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ecommerce_purchase_revenue_in_usd").alias("revenue")
    )
    return rounded(sums, 2, "revenue")


@query(
    "users_by_sketch",
    "ga_events",
    """SELECT event_name, count(*) AS events, true AS within_five_percent FROM ga_events
WHERE event_date >= (SELECT min(event_date) + INTERVAL 3 DAY FROM ga_events)
  AND event_date <= (SELECT max(event_date) - INTERVAL 3 DAY FROM ga_events) GROUP BY 1""",
)
def users_by_sketch(t: Tables) -> DataFrame:
    """Users per event over a range of days from the ingested daily sketches, held against the exact count."""
    reach_table = _ingested(t).table("reach")
    events = t.events()
    days = events.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi")).first()
    lo, hi = days["lo"] + dt.timedelta(days=3), days["hi"] - dt.timedelta(days=3)
    estimated = reach.users_by_event(reach_table, f"{lo:%Y%m%d}", f"{hi:%Y%m%d}")
    exact = events.where(F.col("event_date").between(F.lit(lo), F.lit(hi))).groupBy("event_name").agg(
        F.countDistinct("user_pseudo_id").alias("exact")
    )
    near = F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact")
    return estimated.join(exact, "event_name").select("event_name", "events", near.alias("within_five_percent"))
