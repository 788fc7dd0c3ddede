"""Explicit schemas of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


STRING, LONG, INT, DOUBLE, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType()

# The typed value fields of a parameter, in the order in which they are coalesced.
VALUE_FIELDS = ("string_value", "int_value", "float_value", "double_value")
# Structs that are flattened one level when a day has them.
STRUCT_COLUMNS = ("device", "geo", "traffic_source", "ecommerce")
# Repeated records that have their own flattening.
REPEATED_COLUMNS = ("event_params", "items")

PARAM_VALUE = _fields(string_value=STRING, int_value=LONG, float_value=T.FloatType(), double_value=DOUBLE)
PARAM = _fields(key=STRING, value=PARAM_VALUE)
ITEM = _fields(
    item_id=STRING,
    item_name=STRING,
    item_category=STRING,
    price=DOUBLE,
    price_in_usd=DOUBLE,
    quantity=LONG,
    item_revenue_in_usd=DOUBLE,
)
DEVICE = _fields(category=STRING, web_info=_fields(browser=STRING, browser_version=STRING))
GEO = _fields(country=STRING)
TRAFFIC_SOURCE = _fields(medium=STRING, source=STRING, name=STRING)
ECOMMERCE = _fields(purchase_revenue_in_usd=DOUBLE)

EVENTS_RAW = _fields(
    event_date=STRING,
    event_timestamp=LONG,
    event_name=STRING,
    event_params=T.ArrayType(PARAM),
    user_pseudo_id=STRING,
    device=DEVICE,
    geo=GEO,
    traffic_source=TRAFFIC_SOURCE,
    ecommerce=ECOMMERCE,
    items=T.ArrayType(ITEM),
)

EVENTS_FLAT = _fields(
    event_date=STRING,
    event_timestamp=LONG,
    event_name=STRING,
    user_pseudo_id=STRING,
    device_category=STRING,
    geo_country=STRING,
    traffic_source_medium=STRING,
    traffic_source_source=STRING,
    traffic_source_name=STRING,
    ecommerce_purchase_revenue_in_usd=DOUBLE,
    event_dt=T.TimestampType(),
    day=INT,
    year=INT,
    month=INT,
)

PARAMS_LONG = _fields(
    event_date=STRING,
    event_timestamp=LONG,
    event_name=STRING,
    user_pseudo_id=STRING,
    key=STRING,
    param_value=STRING,
    year=INT,
    month=INT,
)

ITEMS_FLAT = T.StructType(
    _fields(event_date=STRING, event_timestamp=LONG, user_pseudo_id=STRING).fields
    + ITEM.fields
    + _fields(year=INT, month=INT).fields
)

# Per day and event the events and a sketch of the users.
DAILY_REACH = _fields(event_date=STRING, event_name=STRING, events=LONG, users=T.BinaryType(), year=INT, month=INT)

# CSV with an identifier column that looks empty at the head of the file: its type is given, not inferred.
CHECKOUTS = _fields(
    UsageClass=STRING,
    CheckoutType=STRING,
    MaterialType=STRING,
    CheckoutYear=LONG,
    CheckoutMonth=LONG,
    Checkouts=LONG,
    Title=STRING,
    ISBN=STRING,
    Creator=STRING,
    Subjects=STRING,
    Publisher=STRING,
    PublicationYear=STRING,
)

SALES = _fields(region=STRING, category=STRING, year=INT, sales=DOUBLE, revenue=DOUBLE, price=DOUBLE)

INGEST_LOG = _fields(
    day=STRING, status=STRING, rows=LONG, error=STRING, batch_id=LONG, logged_at=T.TimestampType()
)
