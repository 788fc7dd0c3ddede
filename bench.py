"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Every query runs once to warm up and
then ``BENCH_RUNS`` times into a sink that discards the rows; the median counts. File copies in other layouts (CSV,
one Parquet folder, one directory per year) are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys

from eventloom import get_session
from eventloom.fixtures import Tables
from eventloom.plans import checkouts
from eventloom.sources import read_csv, read_parquet, read_partitioned
from eventloom.suite import QUERIES
from eventloom.suite.files import CHECKOUT_SCHEMA
from eventloom.suite.registry import CHECKOUT_COPY_SCHEMA as COPY_SCHEMA, file_copy
from eventloom.timing import mark

HEADLINE = [
    "event_overview", "event_counts", "top_events", "daily_events", "event_date_users", "monthly_event_summary",
    "device_medium_purchases", "device_conversion", "traffic_channels", "top_pages", "page_views_by_device",
    "page_category_counts", "daily_revenue", "daily_revenue_7day", "purchase_by_day", "funnel_sql", "funnel_stages",
    "product_performance", "category_rollup", "user_segments", "sales_by_region", "checkouts_by_year", "book_suffix",
    "book_suffix_2020", "book_by_month", "book_month_desc", "top_title_per_year", "book_vs_ebook", "sessionize",
    "session_number", "p99_session_duration", "bounce_rate", "flatten_structs", "params_long", "items_flat",
    "profile_columns", "numeric_summary",
]


def layouts(t: Tables) -> dict:
    """The checkout queries on each file layout."""
    files = {
        "csv": lambda: read_csv(t.spark, file_copy(t, "checkouts_csv"), CHECKOUT_SCHEMA),
        "parquet": lambda: read_parquet(t.spark, file_copy(t, "checkouts_parquet"), schema=COPY_SCHEMA),
        "partitioned": lambda: read_partitioned(t.spark, file_copy(t, "checkouts_by_year"), COPY_SCHEMA),
    }
    jobs = {
        "book_suffix": lambda df: checkouts.checkouts_by_year(df, suffix="BOOK"),
        "book_suffix_one_year": lambda df: checkouts.checkouts_by_year(df, suffix="BOOK", year=1999),
        "book_months_of_year": lambda df: checkouts.books_of_year(df, 2000),
        "book_by_month": lambda df: checkouts.books_by_month(df, 1998),
    }
    return {
        f"{job}_{layout}": (lambda run=run, read=read: run(read()))
        for job, run in jobs.items()
        for layout, read in files.items()
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    memory = os.environ.get("BENCH_MEMORY", "8g")
    spark = get_session(
        "bench", f"local[{cpus}]", shuffle_partitions=int(cpus),
        **{
            "spark.driver.memory": memory,
            "spark.ui.showConsoleProgress": "false",
            # no call-site bookkeeping per column expression
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    builders = {name: (lambda name=name: QUERIES[name](spark, folder)) for name in HEADLINE} | layouts(t)
    wanted = sys.argv[1:]
    chosen = {name: build for name, build in builders.items() if not wanted or name in wanted}
    timed = {result["name"]: round(result["median"], 4) for result in mark(chosen, runs)}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
