"""Readers, writers, partition pruning, day ranges and the Arrow source."""

import datetime as dt
import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from eventloom import sources, workspace
from eventloom.sources import footers
from eventloom.sources.arrow_ipc import ArrowIpcDataSource
from eventloom.sources.days import calendar
from tests.conftest import plan, rows


@pytest.fixture()
def events(spark):
    return spark.range(100).select(
        F.col("id"),
        F.lit(2020).alias("year") + (F.col("id") % 2).cast("int"),
        (F.col("id") % 3 + 1).cast("int").alias("month"),
        F.concat(F.lit("2024010"), (F.col("id") % 4 + 1).cast("string")).alias("day"),
    ).toDF("id", "year", "month", "day")


def test_partitioned_round_trip_prunes(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events, path, ["year", "month"], max_rows_per_file=10)
    back = sources.read_partitioned(spark, path)
    assert rows(back.select(*events.columns)) == rows(events)
    chosen = back.where("year = 2021 AND month = 1").select("id")
    text = plan(chosen)
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<id:bigint>" in text
    assert chosen.inputFiles() != back.inputFiles() or len(back.inputFiles()) > 6


def test_file_size_is_capped(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events.withColumn("year", F.lit(2020)), path, ["year"], max_rows_per_file=30)
    sizes = [spark.read.parquet(f).count() for f in sources.list_files(spark, f"{path}/year=2020", r"\.parquet$")]
    assert sum(sizes) == 100 and max(sizes) <= 30


def test_dynamic_overwrite_replaces_only_present_partitions(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events, path, ["year"])
    one = events.where("year = 2021").limit(1)
    sources.write_partitioned(one, path, ["year"], replace_only_present=True)
    assert rows(sources.read_partitioned(spark, path).groupBy("year").count()) == [(2020, 50), (2021, 1)]


def test_day_key_stays_text_with_schema(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events.select("id", "day"), path, ["day"])
    inferred = sources.read_partitioned(spark, path)
    pinned = sources.read_partitioned(spark, path, T.StructType().add("id", "long").add("day", "string"))
    assert dict(inferred.dtypes)["day"] == "int" and dict(pinned.dtypes)["day"] == "string"
    assert pinned.where("day = '20240102'").count() == 25


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "lz4"])
def test_codecs(spark, events, tmp_path, codec):
    sources.write_parquet(events, str(tmp_path / codec), codec)
    assert sources.read_parquet(spark, str(tmp_path / codec)).count() == 100


def test_csv_with_type_override(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text("n,isbn\n" + "".join(f"{i},\n" for i in range(50)) + "50,0012\n")
    wide = sources.read_csv_inferred(spark, str(file), {"isbn": T.StringType()})
    assert dict(wide.dtypes) == {"n": "int", "isbn": "string"}
    assert wide.where("n = 50").first().isbn == "0012"
    strict = sources.read_csv(spark, str(file), T.StructType().add("n", "integer").add("isbn", "string"))
    assert strict.count() == 51


def test_file_list_and_glob(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events, path, ["day"])
    assert sources.read_file_list(spark, path, r"2024010[12]$").count() == 50
    assert sources.read_glob(spark, f"{path}/day=2024010[34]").count() == 50
    with pytest.raises(FileNotFoundError):
        sources.read_file_list(spark, path, "nothing")


def test_day_range_reads_only_those_days(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events, path, ["day"])
    some = sources.read_day_range(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 9), prefix="day=")
    assert some.count() == 75
    assert not any("day=20240101" in f for f in some.inputFiles())
    schema = T.StructType().add("id", "long")
    assert sources.read_day_range(spark, path, dt.date(2030, 1, 1), dt.date(2030, 1, 2), schema, "day=").count() == 0
    with pytest.raises(FileNotFoundError):
        sources.read_day_range(spark, path, dt.date(2030, 1, 1), dt.date(2030, 1, 2), prefix="day=")


def test_day_names_match_as_a_whole(spark, tmp_path):
    for name in ("events_20240101", "events_20240102.parquet", "events_intraday_20240101", "events_202401031", "events_latest"):
        spark.range(2).write.parquet(str(tmp_path / name))
    found = sources.list_day_paths(spark, str(tmp_path))
    assert sorted(found) == ["20240101", "20240102"] and all(len(paths) == 1 for paths in found.values())
    assert sources.read_day_range(spark, str(tmp_path), dt.date(2024, 1, 1), dt.date(2024, 1, 31)).count() == 4
    assert sources.read_days(spark, str(tmp_path), ["20240101"], prefix="events_intraday_").count() == 2


def test_inference_sees_every_row(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as file:
        file.write("a,b\n" + "".join(f"{i},{i}\n" for i in range(5000)) + "12A,1\n")
    df = sources.read_csv_inferred(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "int"} and df.where("a = '12A'").count() == 1
    with pytest.raises(Exception, match="12A"):
        sources.read_csv_inferred(spark, path, {"a": T.IntegerType()}).collect()


def test_day_plan(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_partitioned(events, path, ["day"])
    requested = calendar(spark, dt.date(2023, 12, 30), dt.date(2024, 1, 5))
    present, missing = sources.day_plan(requested, sources.available_days(spark, path, "day="))
    assert [r.day for r in present.orderBy("day").collect()] == ["20240101", "20240102", "20240103", "20240104"]
    assert [r.day for r in missing.orderBy("day").collect()] == ["20231230", "20231231", "20240105"]


def test_calendar_has_ninety_two_days(spark):
    assert calendar(spark, dt.date(2020, 11, 1), dt.date(2021, 1, 31)).count() == 92


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2.5, 2)], "d double, i int")
    assert rows(sources.union_all_by_name([a, b]).select("i", "s", "d")) == [(1, "x", None), (2, None, 2.5)]


def test_clustered_files_skip_row_groups(spark, events, tmp_path):
    path = str(tmp_path / "p")
    sources.write_clustered(events, path, ["day", "id"], bloom_columns=["id"])
    found = sources.read_parquet(spark, path).where("id = 7")
    assert found.count() == 1 and "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in plan(found)


def test_files_on_a_curve_can_be_skipped_by_each_column(spark, tmp_path):
    path = str(tmp_path / "p")
    names = ["purchase", "view", "login", "error", "signup", "search", "share", "scroll"]
    df = spark.range(40_000).select(
        F.element_at(F.array(*map(F.lit, names)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(8)).cast("int") + 1).alias("event_name"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3000)).alias("user"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(60)).cast("int")).alias("day"),
        "id",
    )
    sources.write_curved(df, path, ["event_name", "user", "day"], files=700, bloom_columns=["user"])
    written = spark.read.parquet(path)
    assert written.columns == df.columns and written.count() == 40_000 and written.exceptAll(df).isEmpty()
    wanted = {"event_name": "login", "user": 1234, "day": dt.date(2024, 2, 3)}
    groups, hit = 0, dict.fromkeys(wanted, 0)
    for file in glob.glob(f"{path}/*.parquet"):
        footer = pq.ParquetFile(file).metadata
        for g in range(footer.num_row_groups):
            groups += 1
            for k, (name, value) in enumerate(wanted.items()):
                ends = footer.row_group(g).column(k).statistics
                hit[name] += ends.min <= value <= ends.max
    assert groups >= 600 and all(n < groups / 4 for n in hit.values()), (groups, hit)


def test_curve_of_odd_columns(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1, None), (None, None), (1, "a"), (2, "b")] * 3, "i int, s string")
    for k, rows_ in enumerate((df, df.limit(0))):
        sources.write_curved(rows_, str(tmp_path / str(k)), ["i", "s"])
        assert spark.read.schema(df.schema).parquet(str(tmp_path / str(k))).exceptAll(rows_).isEmpty()
        assert spark.read.schema(df.schema).parquet(str(tmp_path / str(k))).count() == rows_.count()
    with pytest.raises(ValueError):
        sources.write_curved(df, str(tmp_path / "x"), ["i", "s"], bits=32)


def test_counts_and_extremes_come_from_footers(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    settings = {k: spark.conf.get(k) for k in (footers.SOURCES, "spark.sql.parquet.aggregatePushdown")}
    counted = footers.count_rows(spark, path)
    text = plan(counted)
    assert "PushedAggregation: [COUNT(*)]" in text and "l_orderkey" not in text
    assert counted.first().rows == spark.read.parquet(path).count()
    ends = footers.extremes(spark, path, ["l_quantity", "l_orderkey"])
    assert "PushedAggregation: [COUNT(l_quantity), MIN(l_quantity), MAX(l_quantity)" in plan(ends)
    lo, hi = spark.read.parquet(path).agg(F.min("l_orderkey").cast("string"), F.max("l_orderkey").cast("string")).first()
    assert tuple(ends.where("column_name = 'l_orderkey'").first())[2:] == (lo, hi)
    assert {k: spark.conf.get(k) for k in settings} == settings
    assert "PushedAggregation: [COUNT(*)]" not in plan(spark.read.parquet(path).groupBy().count())


def test_columns_are_pruned(spark):
    df = sources.read_parquet(spark, "/root/testdata/sf0.001/events.parquet", ["event_type"])
    assert "ReadSchema: struct<event_type:string>" in plan(df)


def test_arrow_files(spark, tmp_path):
    table = pa.table({"i": list(range(1000)), "s": [None if i % 10 == 0 else f"v{i}" for i in range(1000)]})
    for number in range(2):
        with pa.OSFile(str(tmp_path / f"{number}.feather"), "wb") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            for batch in table.to_batches(max_chunksize=20):
                writer.write_batch(batch)
    spark.dataSource.register(ArrowIpcDataSource)
    df = spark.read.format("arrow_ipc").load(str(tmp_path))
    assert dict(df.dtypes) == {"i": "bigint", "s": "string"}
    assert df.rdd.getNumPartitions() == 8
    assert tuple(df.agg(F.count("*"), F.sum("i"), F.count("s")).first()) == (2000, 999000, 1800)


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    """Only what the choice of the shared folder looks at."""

    def __init__(self, master, **conf):
        self.conf, self.sparkContext = conf, FakeContext(master)


def test_shared_folder_comes_from_the_session(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    named = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://x/shared/"})
    assert workspace.shared_folder(named) == "hdfs://x/shared"
    local = FakeSession("local[2]")
    assert workspace.shared_folder(local).startswith(str(tmp_path))
    assert workspace.shared_folder(local) == workspace.shared_folder(local)
    with pytest.raises(RuntimeError):
        workspace.shared_folder(FakeSession("spark://host:7077"))


def test_stage_uses_the_shared_folder(spark):
    staged = workspace.stage(spark.range(3))
    assert all(workspace.shared_folder(spark) in f for f in staged.inputFiles())
    assert spark.conf.get("spark.checkpoint.dir") == workspace.shared_folder(spark)
