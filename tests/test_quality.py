"""File, storage, partition and ingest reports."""

import datetime as dt

from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.plans import quality
from eventloom.sources import folder_files
from tests.conftest import rows


def write(spark, path, files):
    spark.range(0, 1000, 1, files).write.parquet(str(path))


def test_file_counts(spark, tmp_path):
    write(spark, tmp_path / "few", 3)
    write(spark, tmp_path / "many", 85)
    (tmp_path / "none").mkdir()
    folders = {str(tmp_path / n): n for n in ("few", "many", "none", "absent")}
    got = {r.description: (r.n_files, r.status) for r in quality.file_counts(spark, folders).collect()}
    assert got == {
        "few": (3, "only 3 files"),
        "many": (85, "85 files"),
        "none": (0, "empty"),
        "absent": (0, "folder missing"),
    }


def test_storage_summary(spark, tmp_path):
    write(spark, tmp_path / "a", 2)
    write(spark, tmp_path / "b", 3)
    got = quality.storage_summary(spark, [str(tmp_path / n) for n in ("a", "b", "absent")]).collect()
    assert {r.folder.rsplit("/", 1)[-1]: r.n_files for r in got} == {"a": 2, "b": 3, "total": 5}
    assert quality.storage_summary(spark, [str(tmp_path / "absent")]).count() == 0


def test_layout_check(spark, tmp_path):
    write(spark, tmp_path / "a", 4)
    row = quality.layout_check(folder_files(spark, str(tmp_path / "a"))).first()
    assert (row.n_files, row.too_small) == (4, 4) and row.advice.startswith("small files")
    sizes = spark.createDataFrame([("big", "p", 3 * 2**30), ("ok", "p", 2**28)], "folder string, path string, length long")
    assert rows(quality.layout_check(sizes).select("folder", "advice")) == [
        ("big", "large files: limit the rows per file"),
        ("ok", "ok"),
    ]


def test_partition_types(spark):
    good = spark.createDataFrame([(1, 2)], "year int, month int")
    assert quality.partition_types(good) == {"year": True, "month": True}
    assert quality.partition_types(good.select(F.col("year").cast("string"))) == {"year": False, "month": False}


def log(spark, *entries):
    at = dt.datetime(2024, 1, 1)
    data = [(d, s, r, None, i, at + dt.timedelta(minutes=i)) for i, (d, s, r) in enumerate(entries)]
    return spark.createDataFrame(data, schemas.INGEST_LOG)


def test_latest_log_entry_counts(spark):
    entries = log(
        spark, ("20240101", "error", None), ("20240101", "success", 5), ("20240201", "success", 7), ("20240202", "error", None)
    )
    latest = quality.latest_log(entries)
    assert rows(quality.ingest_status(latest)) == [("error", 1), ("success", 2)]
    assert rows(quality.ingest_monthly(latest)) == [("Feb 2024", 1, 7, 7.0), ("Jan 2024", 1, 5, 5.0)]
    assert [r.day for r in quality.ingest_failures(latest).collect()] == ["20240202"]
    requested = spark.createDataFrame([("20240101",), ("20240202",), ("20240203",)], "day string")
    assert rows(quality.still_needed(requested, latest)) == [("20240202",), ("20240203",)]
