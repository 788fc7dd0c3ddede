"""Gap sessions against a plain Python loop, with a user holding most of the events."""

import random
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventloom.operators import number_sessions, session_activity, user_day_sessions
from tests.conftest import plan, rows

MINUTE = 60_000_000


def loop(events, gap):
    """(id, user, micros) to {id: number}, one user after the other."""
    by_user, numbers = defaultdict(list), {}
    for event_id, user, micros in events:
        by_user[user].append((micros, event_id))
    for times in by_user.values():
        number, last = 0, None
        for micros, event_id in sorted(times):
            if last is None or micros - last > gap:
                number += 1
            numbers[event_id], last = number, micros
    return numbers


def frame(spark, events):
    return spark.createDataFrame(events, "event_id long, user_pseudo_id long, event_timestamp long")


def check(spark, events, minutes=30):
    df = frame(spark, events)
    expected = loop(events, minutes * MINUTE)
    got = {r.event_id: r.session_number for r in number_sessions(df, gap_minutes=minutes).collect()}
    assert got == expected
    per_session = defaultdict(list)
    for event_id, user, micros in events:
        per_session[(user, expected[event_id])].append(micros)
    activity = session_activity(df, gap_minutes=minutes).collect()
    assert {(r.user_pseudo_id, r.session_number): (r.first_us, r.last_us, r.events) for r in activity} == {
        key: (min(times), max(times), len(times)) for key, times in per_session.items()
    }


def test_hot_user(spark):
    random.seed(5)
    hot = [(i, 1, random.randrange(0, 3000 * MINUTE)) for i in range(400)]
    others = [(i, random.randrange(2, 20), random.randrange(0, 3000 * MINUTE)) for i in range(400, 900)]
    check(spark, hot + others)


def test_exact_gap_edges_and_times_before_the_epoch(spark):
    gap = 30 * MINUTE
    times = [-gap - 1, -1, 0, gap - 1, gap, 2 * gap, 3 * gap + 1, 3 * gap + 1, 10 * gap, 11 * gap]
    check(spark, [(i, 1, t) for i, t in enumerate(times)])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(-200, 200)), min_size=1, max_size=60))
def test_random_events(spark, pairs):
    check(spark, [(i, user, minute * MINUTE // 2) for i, (user, minute) in enumerate(pairs)], minutes=7)


def test_events_without_user_or_time_have_no_number(spark):
    df = frame(spark, [(1, None, 5), (2, 1, None), (3, 1, 5)])
    assert rows(number_sessions(df).select("event_id", "session_number")) == [(1, None), (2, None), (3, 1)]


def test_first_event_wins(spark):
    df = spark.createDataFrame(
        [(1, 9, 20, "late"), (2, 9, 10, "first"), (3, 9, 10, "tie")], "event_id long, user_pseudo_id long, event_timestamp long, page string"
    )
    got = session_activity(df, keep_first=["page"], order_by=["event_id"]).first()
    assert (got.page, got.events) == ("first", 3)


def test_user_day_sessions_take_the_earliest_attributes(spark):
    df = spark.createDataFrame(
        [("u", "20210101", 20, "mobile"), ("u", "20210101", 10, "desktop"), ("u", "20210102", 5, "tablet")],
        "user_pseudo_id string, event_date string, event_timestamp long, device_category string",
    )
    got = rows(user_day_sessions(df, ["device_category"]))
    assert got == [("u", "20210101", "desktop"), ("u", "20210102", "tablet")]


def test_events_are_reduced_before_the_shuffle(spark):
    """Between the events and the first exchange there is a partial aggregate per user and slot."""
    df = spark.range(1000).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_pseudo_id"), (F.col("id") * 1000).alias("event_timestamp")
    )
    text = plan(session_activity(df.withColumn("device", F.concat(F.lit("x"), "user_pseudo_id")), per_user=["device"]))
    assert "SortAggregate" not in text
    text = plan(session_activity(df))
    deepest = text[text.rindex("Exchange hashpartitioning") :]
    assert "partial_min(event_timestamp" in deepest and "Window" not in deepest
