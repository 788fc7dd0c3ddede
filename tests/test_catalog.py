"""Views, tables, SQL and the read-only flag."""

import pytest

from eventloom.catalog import Catalog, ReadOnlyError
from eventloom.operators import udf_report
from eventloom.suite.inspection import _bracketed
from tests.conftest import plan, rows


def test_tables_and_views(spark):
    catalog = Catalog(spark, "shop")
    catalog.create_table("a", spark.range(10).withColumnRenamed("id", "k"), bucket_by=["k"], buckets=4, sort_by=["k"])
    catalog.create_table("b", spark.range(5).withColumnRenamed("id", "k"), bucket_by=["k"], buckets=4, sort_by=["k"])
    assert catalog.tables() == ["a", "b"]
    assert rows(catalog.row_counts()) == [("a", 10), ("b", 5)]
    catalog.register("some_view", spark.range(3))
    assert catalog.sql("SELECT count(*) AS n FROM some_view").first().n == 3
    assert catalog.sql("SELECT count(*) AS n FROM {f}", f=spark.range(4)).first().n == 4
    assert catalog.tables() == ["a", "b"]
    reader = Catalog(spark, "shop", read_only=True)
    assert reader.table("a").count() == 10
    for write in (
        lambda: reader.create_table("c", spark.range(1)),
        lambda: reader.drop_table("a"),
        lambda: reader.sql("DROP TABLE shop.a"),
    ):
        with pytest.raises(ReadOnlyError):
            write()
    for text in (
        "WITH x AS (SELECT * FROM shop.a) INSERT INTO shop.a SELECT * FROM x",
        "/* SELECT */ INSERT INTO shop.a VALUES (1)",
        "FROM shop.a INSERT INTO shop.a SELECT k INSERT INTO shop.b SELECT k",
        "CREATE TABLE shop.c AS SELECT 1 AS k",
        "TRUNCATE TABLE shop.a",
        "SET x = y",
    ):
        with pytest.raises(ReadOnlyError):
            reader.sql(text)
    assert reader.table("a").count() == 10
    for text in ("-- note\nSELECT 1", "\tVALUES (1), (2)", "EXPLAIN SELECT 1", "SHOW TABLES IN shop", "WITH x AS (SELECT 1) SELECT * FROM x"):
        assert reader.sql(text).count()
    assert reader.sql("SELECT count(*) AS n FROM {f}", f=spark.range(4)).first().n == 4
    catalog.drop_table("b")
    assert catalog.tables() == ["a"]


def test_bucketed_tables_join_without_shuffle(spark):
    catalog = Catalog(spark, "buckets")
    for name in ("x", "y"):
        catalog.create_table(name, spark.range(1000).withColumnRenamed("id", "k"), bucket_by=["k"], buckets=4, sort_by=["k"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = catalog.table("x").join(catalog.table("y"), "k")
        assert "Exchange" not in plan(joined) and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_user_function_registered_by_name(spark):
    spark.udf.register("bracketed", _bracketed)
    spark.createDataFrame([("a",)], "name string").createOrReplaceTempView("names")
    labelled = spark.sql("SELECT bracketed(name) AS label FROM names")
    assert labelled.first().label == "[a]" and udf_report(labelled)
