"""Incremental ingest: re-run, new day, late file, replay, failing day, vanished items, further columns, odd names."""

import datetime as dt
import os

import pandas as pd
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.plans import quality, reach
from eventloom.sources.compaction import Bounds, files_of, misfits, pack
from eventloom.sources.listing import list_files
from eventloom.streaming import DailyIngest
from eventloom.streaming.ingest import IngestError
from tests.conftest import rows

ITEM = ("i1", "Shirt", "Apparel", 10.0, 9.0, 2, 18.0)


def day_file(spark, root, day, ids, name="a", event="purchase", items=(ITEM,)):
    data = [
        (day, i, event, [("k", (None, i, None, None))], f"u{i}", ("mobile", None), ("Fiji",), None, (1.5,), list(items))
        for i in ids
    ]
    df = spark.createDataFrame(data, schemas.EVENTS_RAW).coalesce(1)
    df.write.mode("append").parquet(f"{root}/events_{day}")


@pytest.fixture()
def ingest(spark, tmp_path):
    return DailyIngest(spark, str(tmp_path / "raw"), str(tmp_path / "out"))


def counts(ingest, table="events"):
    return dict(rows(ingest.table(table).groupBy("event_date").count()))


def test_incremental_runs(spark, ingest, tmp_path):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(4))
    ingest.run()
    assert counts(ingest) == counts(ingest, "params") == counts(ingest, "items") == {"20240101": 3, "20240102": 4}
    ingest.run()
    assert counts(ingest) == {"20240101": 3, "20240102": 4}
    day_file(spark, ingest.raw, "20240201", range(2))
    ingest.run()
    assert counts(ingest) == {"20240101": 3, "20240102": 4, "20240201": 2}
    # a late second file: the whole day is there, once
    day_file(spark, ingest.raw, "20240102", range(10, 15))
    ingest.run()
    assert counts(ingest)["20240102"] == counts(ingest, "items")["20240102"] == 9
    # everything again with a new checkpoint
    ingest.run(checkpoint=str(tmp_path / "other"))
    assert counts(ingest) == counts(ingest, "params") == {"20240101": 3, "20240102": 9, "20240201": 2}
    latest = quality.latest_log(ingest.log())
    assert rows(latest.select("day", "status", "rows")) == [
        ("20240101", "success", 3),
        ("20240102", "success", 9),
        ("20240201", "success", 2),
    ]
    events = ingest.table("events")
    assert dict(events.dtypes)["event_date"] == "string" and quality.partition_types(events) == {"year": True, "month": True}
    assert rows(events.where("event_date = '20240201'").select("event_timestamp", "year", "month", "day")) == [
        (0, 2024, 2, 1),
        (1, 2024, 2, 1),
    ]


def test_failing_day_does_not_stop_the_others(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(1))
    with open(f"{ingest.raw}/events_20240102/broken.parquet", "wb") as file:
        file.write(b"not a parquet file at all")
    with pytest.raises(IngestError, match="20240102"):
        ingest.run()
    assert counts(ingest) == {"20240101": 3}
    latest = quality.latest_log(ingest.log())
    assert rows(latest.select("day", "status")) == [("20240101", "success"), ("20240102", "error")]
    assert len(quality.ingest_failures(latest).first().error) > 100
    # the broken file goes away: no new file, but the day is loaded by the next run
    os.remove(f"{ingest.raw}/events_20240102/broken.parquet")
    ingest.run()
    assert counts(ingest) == {"20240101": 3, "20240102": 1}


def test_rows_of_another_day_fail(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    other = spark.read.schema(schemas.EVENTS_RAW).parquet(f"{ingest.raw}/events_20240101")
    other.withColumn("event_date", F.lit("20231231")).write.parquet(f"{ingest.raw}/events_20240105")
    with pytest.raises(IngestError):
        ingest.run()
    assert counts(ingest) == {"20240101": 3}
    assert rows(quality.ingest_failures(quality.latest_log(ingest.log())).select("day")) == [("20240105",)]


def test_day_that_loses_its_items(spark, ingest, tmp_path):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(2))
    ingest.run()
    rewritten = DailyIngest(spark, str(tmp_path / "raw2"), ingest.target)
    day_file(spark, rewritten.raw, "20240101", range(3), event="view_item")
    rewritten.ingest_days(["20240101"])
    assert counts(ingest, "items") == {"20240102": 2}
    assert counts(ingest) == {"20240101": 3, "20240102": 2}


def test_large_raw_files_can_be_written_without_a_shuffle(spark, tmp_path):
    ingest = DailyIngest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), rebalance=False)
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(4))
    ingest.run()
    ingest.run(checkpoint=str(tmp_path / "other"))
    assert counts(ingest) == counts(ingest, "items") == {"20240101": 3, "20240102": 4}


def test_nothing_ingested_yet(ingest):
    assert ingest.table("items").count() == 0 and ingest.log().count() == 0


def test_schema_drift(spark, ingest):
    """A day without items, ecommerce and one value field."""
    day_file(spark, ingest.raw, "20240101", range(2))
    narrow = spark.createDataFrame(
        [("20240102", 5, "e", [("k", ("text",))], "u")],
        "event_date string, event_timestamp long, event_name string,"
        " event_params array<struct<key:string,value:struct<string_value:string>>>, user_pseudo_id string",
    )
    narrow.write.parquet(f"{ingest.raw}/events_20240102")
    ingest.run()
    assert counts(ingest) == {"20240101": 2, "20240102": 1}
    assert rows(ingest.table("params").where("event_date = '20240102'").select("key", "param_value")) == [("k", "text")]


def test_all_columns_of_a_day_are_kept(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(2))
    more = spark.createDataFrame(
        [("20240102", 5, "purchase", "u", "web", 7, ("Fiji", "Suva"), [("i9", 4.0, "blue")])],
        "event_date string, event_timestamp long, event_name string, user_pseudo_id string, platform string, batch int,"
        " geo struct<country:string,city:string>, items array<struct<item_id:string,price:double,item_variant:string>>",
    )
    more.write.parquet(f"{ingest.raw}/events_20240102")
    ingest.run()
    events = ingest.table("events")
    assert dict(events.dtypes)["batch"] == "bigint"
    assert rows(events.where("event_date = '20240102'").select("platform", "geo_city", "geo_country", "batch")) == [
        ("web", "Suva", "Fiji", 7)
    ]
    assert events.where("platform IS NULL AND event_date = '20240101'").count() == 2
    assert rows(ingest.table("items").where("event_date = '20240102'").select("item_id", "price", "item_variant")) == [
        ("i9", 4.0, "blue")
    ]


def test_half_written_day_is_not_visible(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    clash = spark.createDataFrame(
        [("20240102", 5, "purchase", "u", [("i", "not a price")])] * 2,
        "event_date string, event_timestamp long, event_name string, user_pseudo_id string,"
        " items array<struct<item_id:string,price:string>>",
    )
    clash.write.parquet(f"{ingest.raw}/events_20240102")
    with pytest.raises(IngestError):
        ingest.run()
    assert counts(ingest) == counts(ingest, "params") == counts(ingest, "items") == {"20240101": 3}


def test_a_day_is_built_once_per_run(spark, tmp_path):
    ingest = DailyIngest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), files_per_batch=2)
    for k in range(6):
        day_file(spark, ingest.raw, "20240101", [k])
    ingest.run()
    assert counts(ingest) == {"20240101": 6}
    assert ingest.log().where("status = 'success'").count() == 1


def test_names_that_are_no_day_are_logged(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    for other in ("latest", "intraday_20240101", "202401019"):
        day_file(spark, ingest.raw, other, range(5))
    ingest.run()
    assert counts(ingest) == {"20240101": 3}
    assert {r.day for r in quality.ingest_failures(ingest.log()).collect()} == {
        "events_latest", "events_intraday_20240101", "events_202401019"
    }


def test_requested_days_that_are_there_are_skipped(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(2))
    ingest.request(["20240101"])
    ingest.request(["20240101", "20240102"])
    latest = quality.latest_log(ingest.log())
    assert rows(latest.select("day", "status")) == [("20240101", "skipped"), ("20240102", "success")]
    assert counts(ingest) == {"20240101": 3, "20240102": 2}


def test_a_rebuilt_day_stays_readable(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(4))
    ingest.run()
    planned = ingest.table("events").where("event_date = '20240101'")
    day_file(spark, ingest.raw, "20240101", range(10, 17))
    ingest.run()
    assert planned.count() == 3 and rows(planned.select("user_pseudo_id")) == [("u0",), ("u1",), ("u2",)]
    assert counts(ingest) == counts(ingest, "params") == {"20240101": 10, "20240102": 4}


def test_a_broken_rebuild_leaves_the_old_day(spark, ingest, monkeypatch):
    day_file(spark, ingest.raw, "20240101", range(3))
    ingest.run()
    day_file(spark, ingest.raw, "20240101", range(10, 12))
    write, published = ingest.tables.write, ingest.tables.current()

    def broken(name, *rest, **options):
        if name == "items":
            raise OSError("disk full")
        return write(name, *rest, **options)

    monkeypatch.setattr(ingest.tables, "write", broken)
    with pytest.raises(IngestError):
        ingest.run()
    assert counts(ingest) == counts(ingest, "params") == counts(ingest, "items") == {"20240101": 3}
    assert ingest.tables.current() == published
    monkeypatch.undo()
    ingest.run()
    assert counts(ingest) == counts(ingest, "items") == {"20240101": 5}


def test_old_versions_go_after_the_retention_time(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    day_file(spark, ingest.raw, "20240102", range(4))
    ingest.run()
    ingest.ingest_days(["20240101"])
    old = ingest.table("events", )
    ingest.ingest_days(["20240101"])
    versions = lambda: len(list_files(spark, ingest.path("events"), "version="))
    ingest.tables.expire()
    assert versions() == 3 and old.count() == 7
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=8)
    ingest.tables.expire(later)
    # the first version still has the second day; its first day and the second version are gone
    assert versions() == 2 and counts(ingest) == counts(ingest, "items") == {"20240101": 3, "20240102": 4}
    assert len(spark.read.parquet(ingest.path("events")).select("version", "event_date").distinct().collect()) == 2
    ingest.run()
    assert counts(ingest) == {"20240101": 3, "20240102": 4}


def test_two_writers_do_not_lose_a_change(spark, ingest):
    tables = ingest.tables
    tables.publish("20240101000000-0000000a", ["a"], {"events": {"a": 1}})
    current, turns = tables.current, []

    def late():
        seen = current()
        if not turns:
            turns.append(1)
            tables.publish("20240101000000-0000000b", ["b"], {"events": {"b": 2}})
        return seen

    tables.current = late
    tables.publish("20240101000000-0000000c", ["c"], {"events": {"c": 3}})
    assert current().rows("events") == {"a": 1, "b": 2, "c": 3} and current().number == 3
    # a writer that only rearranges rows gives way to a change of the rows
    tables.current, seen = current, current()
    tables.publish("20240101000000-0000000d", ["a"], {"events": {"a": 5}})
    tables.publish("20240101000000-0000000e", ["a", "b"], {"events": {"a": 1, "b": 2}}, seen=seen)
    assert tables.current().parts["events"]["a"] == ("20240101000000-0000000d", 5)
    assert tables.current().parts["events"]["b"] == ("20240101000000-0000000e", 2)


def test_tables_do_not_open_files_to_plan(spark, ingest):
    day_file(spark, ingest.raw, "20240101", range(3))
    ingest.run()
    assert "version" not in ingest.table("events").columns
    assert ingest.tables.current().rows("events") == {"20240101": 3}
    events = ingest.table("events").where("event_date = '20240109'")
    assert events.count() == 0


def test_compaction(spark, tmp_path):
    ingest = DailyIngest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), rebalance=False, max_rows_per_file=150)
    day_file(spark, ingest.raw, "20240101", range(3000))
    day_file(spark, ingest.raw, "20240102", range(40))
    for k in range(5):
        day_file(spark, ingest.raw, "20240103", range(100 * k, 100 * k + 90))
    ingest.run()
    before = {name: rows(ingest.table(name)) for name in ("params", "items")}
    planned = ingest.table("params")
    files = lambda name: files_of(ingest.table(name), "event_date")
    sizes = [r.length for r in files("params").where("part = '20240101'").collect()]
    assert len(sizes) == 20
    bounds = Bounds(smallest=max(sizes) + 1, largest=40 * max(sizes))
    assert ingest.compact(bounds)["params"] == ["20240101", "20240103"]
    assert {name: rows(ingest.table(name)) for name in before} == before
    assert misfits(files("params"), bounds).where("too_large > 0 OR too_small > 0").count() == 0
    assert files("params").where("part = '20240101'").count() < 20 and planned.count() == 3490
    assert ingest.compact(bounds) == {"events": [], "params": [], "items": [], "reach": []}
    # the other way: a large file is split
    (size,) = {r.length for r in files("params").where("part = '20240101'").orderBy(F.desc("length")).limit(1).collect()}
    bounds = Bounds(smallest=1, largest=size - 1)
    assert "20240101" in ingest.compact(bounds)["params"]
    assert {name: rows(ingest.table(name)) for name in before} == before
    # rows keep their order
    ids = [r.event_timestamp for r in spark.read.parquet(files("params").where("part = '20240101'").orderBy("path").first().path).collect()]
    assert ids == sorted(ids)


def test_very_small_files_are_packed_until_they_are_in_bounds(spark, tmp_path):
    ingest = DailyIngest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), max_rows_per_file=8)
    day_file(spark, ingest.raw, "20240101", range(2400))
    day_file(spark, ingest.raw, "20240102", range(10))
    ingest.run()
    before = rows(ingest.table("events"))
    bounds = Bounds(smallest=24 * 1024, largest=1024 * 1024)
    assert ingest.compact(bounds)["events"] == ["20240101", "20240102"]
    files = files_of(ingest.table("events"), "event_date")
    assert misfits(files, bounds).where("too_large > 0 OR too_small > 0").collect() == []
    assert rows(ingest.table("events")) == before and files.count() < 10
    assert ingest.compact(bounds) == {"events": [], "params": [], "items": [], "reach": []}


def test_very_small_files_are_looked_at_in_few_tasks(spark, tmp_path):
    most = 8 * spark.sparkContext.defaultParallelism
    path, usual = str(tmp_path / "p"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(most + 60).withColumn("day", F.lit("a")).coalesce(1).write.option("maxRecordsPerFile", 1).partitionBy("day").parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # what Spark takes each file for
    spark.sparkContext.setJobGroup("few-tasks", "")
    try:
        assert len(files_of(spark.read.parquet(path), "day").collect()) == most + 60
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    seen = spark.sparkContext.statusTracker()
    infos = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup("few-tasks") for s in seen.getJobInfo(j).stageIds]
    assert 0 < max(i.numTasks for i in infos if i) <= most


def test_users_of_a_period_without_its_events(spark, ingest):
    for day in ("20240101", "20240102", "20240103"):
        day_file(spark, ingest.raw, day, range(int(day[-2:]) * 100, int(day[-2:]) * 100 + 200), event="view")
    ingest.run()
    found = reach.users_by_event(ingest.table("reach"), "20240101", "20240102")
    files = found.inputFiles()
    assert files and all("/reach/" in f for f in files)
    (row,) = found.collect()
    assert row.events == 400 and abs(row.users - 300) <= 15
    (row,) = reach.users_of_any(ingest.table("reach")).collect()
    assert row.events == 600 and abs(row.users - 400) <= 20
    day_file(spark, ingest.raw, "20240102", range(1000, 1100), event="buy")
    ingest.run()
    got = {r.event_name: r.users for r in reach.users_by_event(ingest.table("reach")).collect()}
    assert abs(got["buy"] - 100) <= 5 and abs(got["view"] - 400) <= 20


@given(st.lists(st.integers(1, 500), min_size=1, max_size=40), st.integers(1, 30))
def test_packing(lengths, smallest):
    bounds = Bounds(smallest, 16 * smallest)
    plan = pack(pd.DataFrame({"path": [f"f{i:03d}" for i in range(len(lengths))], "length": lengths}), bounds)
    size = dict(zip([f"f{i:03d}" for i in range(len(lengths))], lengths))
    new = {}
    for row in plan.itertuples():
        for piece in range(row.pieces):
            new[row.first + piece] = new.get(row.first + piece, 0) + size[row.path] / row.pieces
    assert sorted(new) == list(range(len(new))) and sum(new.values()) == pytest.approx(sum(lengths))
    assert all(n <= bounds.largest for n in new.values())
    assert sum(n < bounds.aim / 2 for n in new.values()) <= 1
