"""Rectangling of hand-written nested rows."""

import pytest
from pyspark.sql import functions as F, types as T

from eventloom import schemas
from eventloom.operators import flatten_event_params, flatten_items, flatten_structs, params_for_key
from tests.conftest import rows

IDS = ("20210101", 1_609_459_200_000_000)


def value(string=None, integer=None, real=None, double=None):
    return (string, integer, real, double)


def raw(spark, *events):
    """Rows given as dicts; missing fields are NULL."""
    names = schemas.EVENTS_RAW.fieldNames()
    data = [
        tuple({"event_date": IDS[0], "event_timestamp": IDS[1], "event_name": "e", "user_pseudo_id": "u", **event}.get(n) for n in names)
        for event in events
    ]
    return spark.createDataFrame(data, schemas.EVENTS_RAW)


def test_params_take_the_first_typed_value(spark):
    params = [
        ("all", value("s", 1, 2.5, 3.5)),
        ("int", value(None, 1, 2.5, 3.5)),
        ("float", value(None, None, 2.5, 3.5)),
        ("double", value(None, None, None, 3.5)),
        ("none", value()),
        ("null", None),
    ]
    got = rows(flatten_event_params(raw(spark, {"event_params": params})).select("key", "param_value"), "key")
    assert got == [("all", "s"), ("double", "3.5"), ("float", "2.5"), ("int", "1"), ("none", None), ("null", None)]


def test_empty_and_null_arrays_vanish(spark):
    df = raw(spark, {"event_params": []}, {"event_params": None})
    assert flatten_event_params(df).count() == 0


def test_param_with_fewer_value_fields(spark):
    df = raw(spark, {"event_params": [("k", value(None, 7))]})
    narrow = df.withColumn(
        "event_params",
        F.transform("event_params", lambda p: F.struct(p["key"].alias("key"), F.struct(p["value"]["int_value"].alias("int_value")).alias("value"))),
    )
    assert rows(flatten_event_params(narrow).select("key", "param_value")) == [("k", "7")]


def test_missing_params_column_gives_empty_table_with_schema(spark):
    empty = flatten_event_params(raw(spark, {}).drop("event_params"))
    assert empty.count() == 0
    assert empty.columns == ["event_date", "event_timestamp", "event_name", "user_pseudo_id", "key", "param_value"]


def test_params_for_key_equals_filtered_params(spark):
    df = raw(spark, {"event_params": [("a", value("x")), ("b", value("y"))]}, {"event_params": [("a", value(None, 2))]})
    expected = rows(flatten_event_params(df).where("key = 'a'"))
    assert rows(params_for_key(df, "a")) == expected and len(expected) == 2


def test_structs_flatten_one_level(spark):
    df = raw(spark, {"device": ("mobile", ("firefox", "1")), "geo": ("Fiji",), "ecommerce": (2.5,)})
    flat = flatten_structs(df)
    assert not any(isinstance(f.dataType, (T.StructType, T.ArrayType)) for f in flat.schema)
    row = flat.first()
    assert (row.device_category, row.geo_country, row.ecommerce_purchase_revenue_in_usd) == ("mobile", "Fiji", 2.5)
    assert (row.year, row.month, row.day) == (2021, 1, 1)
    assert "device_web_info" not in flat.columns and "device_web_info_browser" not in flat.columns


def test_structs_flatten_deeper_on_request(spark):
    df = raw(spark, {"device": ("mobile", ("firefox", "1"))})
    assert flatten_structs(df, max_depth=2).first()["device_web_info_browser"] == "firefox"


def test_absent_struct_is_skipped(spark):
    df = raw(spark, {"geo": ("Fiji",)}).drop("ecommerce")
    flat = flatten_structs(df)
    assert flat.first()["geo_country"] == "Fiji"
    assert not any(c.startswith("ecommerce") for c in flat.columns)


def test_bad_event_date_gives_null_parts(spark):
    row = flatten_structs(raw(spark, {"event_date": "2021013"})).first()
    assert (row.year, row.month, row.day) == (None, None, None)


ITEM = ("i1", "Shirt", "Apparel", 10.0, 9.0, 2, 18.0)


@pytest.mark.parametrize(
    "events, expected",
    [
        ([{"event_name": "view_item", "items": [ITEM]}], 0),
        ([{"event_name": "purchase", "items": []}, {"event_name": "purchase"}], 0),
        ([{"event_name": "purchase", "items": [ITEM, ITEM]}], 2),
    ],
)
def test_items_of_purchases_only(spark, events, expected):
    flat = flatten_items(raw(spark, *events))
    assert flat.count() == expected
    assert flat.columns[3:] == schemas.ITEM.fieldNames()


def test_missing_items_column(spark):
    assert flatten_items(raw(spark, {}).drop("items")).count() == 0
