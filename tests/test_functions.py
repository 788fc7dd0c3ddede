"""Scalar helpers on hand-written values."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventloom import functions as X


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


def test_url_path_forms(spark):
    urls = ["", "https://h", "https://h/?a=1", "https://h/p#f", "https://h/p?u=https://g/x", None]
    assert apply(spark, X.url_path, urls) == ["/", "/", "/", "/p", "/p", "/"]


def test_url_path_keep_fragment_removes_the_first_host_only(spark):
    urls = ["https://h/p#f", "x https://a/b https://c/d", "https://h?q"]
    assert apply(spark, X.url_path_keep_fragment, urls) == ["/p#f", "x /b https://c/d", ""]


def test_url_path_one_pass(spark):
    assert apply(spark, X.url_path_one_pass, ["https://h/p?x=https://g/y", "https://h/p#f"]) == ["/p", "/p#f"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab/?#:.htps", max_size=25), min_size=20, max_size=40))
def test_url_path_against_python(spark, texts):
    urls = [p + t for p, t in zip(["", "https://", "http://h.x/"] * 20, texts)]

    def python(url):
        path = re.sub(r"^https?://[^/]+", "", url)
        path = re.sub(r"#.*$", "", re.sub(r"\?.*$", "", path))
        return path or "/"

    assert apply(spark, X.url_path, urls) == [python(u) for u in urls]


def test_page_section_precedence(spark):
    paths = ["/", "/shop/cart", "/basket", "/a/basket", "/google+re/x", "/a/store", "/product/1", "/checkout", "/x"]
    expected = ["Home", "Cart", "Cart", "Other", "Store", "Store", "Products", "Checkout", "Other"]
    assert apply(spark, X.page_section, paths) == expected


def test_title_case(spark):
    texts = ["(data deleted)", "<Other>", "paid social", "email-news", "", None]
    assert apply(spark, X.title_case, texts) == ["(Data Deleted)", "<Other>", "Paid Social", "Email-News", "", None]


def test_channel_group(spark):
    media = [None, "(none)", "organic", "cpc", "ppc", "my-email", "paid social", "referral"]
    expected = ["Direct", "Direct", "Organic Search", "Paid Search", "Paid Search", "Email", "Social", "Referral"]
    assert apply(spark, X.channel_group, media) == expected


def test_parse_day_gives_null_on_bad_text(spark):
    days = ["20210115", "2021013", "xx", "20210230", "2021-01-15", None]
    assert apply(spark, X.parse_day, days) == [dt.date(2021, 1, 15), None, None, None, None, None]


def test_extract_day(spark):
    assert apply(spark, X.extract_day, ["events_20210101", "events", None]) == ["20210101", None, None]


def test_user_type_of_bad_number_is_null(spark):
    assert apply(spark, X.user_type, ["1", "2", "x", None]) == ["New User", "Returning User", None, None]


def test_remove_first_only(spark):
    assert apply(spark, lambda c: X.remove_first(c, "a+"), ["baaca", "xyz", "a\na"]) == ["bca", "xyz", "\na"]


def test_truncate_label(spark):
    assert apply(spark, lambda c: X.truncate_label(c, 8), ["12345678", "123456789", None]) == ["12345678", "12345...", None]
    with pytest.raises(ValueError):
        X.truncate_label(F.col("x"), 3)


def test_is_blank(spark):
    assert apply(spark, X.is_blank, [" ", "", "a ", None]) == [True, True, False, True]


def test_recode_and_position(spark):
    assert apply(spark, lambda c: X.recode(c, {"a": "A"}), ["a", "b", None]) == ["A", "b", None]
    assert apply(spark, lambda c: X.position_in(c, ["p", "q"]), ["q", "p", "r", None]) == [2, 1, None, None]


def test_if_else_keeps_null(spark):
    result = apply(spark, lambda c: X.if_else(c > 1, F.lit("y"), F.lit("n")), [2, 1, None], "int")
    assert result == ["y", "n", None]


def test_not_in_counts_null_as_absent(spark):
    assert apply(spark, lambda c: X.not_in(c, ["a"]), ["a", "b", None]) == [False, True, True]


def test_safe_divide(spark):
    assert apply(spark, lambda c: X.safe_divide(F.lit(1), c), [2, 0, None], "int") == [0.5, None, None]


def test_labels(spark):
    assert apply(spark, X.comma, [1234567], "bigint") == ["1,234,567"]
    assert apply(spark, X.percent, [0.1234], "double") == ["12.3%"]
    assert apply(spark, X.dollar, [1234.5], "double") == ["$1,234.50"]
    assert apply(spark, X.bracket_label, ["a"]) == ["[a]"]
    assert apply(spark, X.period_label, [dt.date(2020, 11, 3)], "date") == ["Nov 2020"]
    assert apply(spark, X.month_floor, [dt.date(2020, 11, 3)], "date") == [dt.date(2020, 11, 1)]


def test_event_time_is_exact(spark):
    micros = 1_604_188_800_123_457
    text = apply(spark, lambda c: X.event_time(c).cast("string"), [micros], "bigint")
    assert text == ["2020-11-01 00:00:00.123457"]
