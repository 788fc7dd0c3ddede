"""Quantiles, ranking, shares, rolling means, profiles, comparison and execution helpers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import (
    PythonUdfError,
    apply_policy,
    collect_limited,
    compute,
    describe_table,
    distinct_profile,
    exact_quantiles,
    frame_difference,
    histogram,
    numeric_summary,
    profile,
    rolling_mean_days,
    rolling_mean_rows,
    share_of_total,
    top_per_group,
    udf_report,
    with_total,
)
from eventloom.operators import quantiles
from eventloom.suite import QUERIES
from tests.conftest import optimized, plan, rows


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_equal_numpy(spark, accuracy):
    """With accuracy 20 the sketch only gives rough bounds; the result must be exact all the same."""
    random.seed(1)
    data = [("normal", random.gauss(0, 10)) for _ in range(3000)]
    data += [("ties", float(random.choice([1, 1, 1, 2, 50]))) for _ in range(2000)]
    data += [("few", float(v)) for v in (3, 1, 2)] + [(None, 4.0), (None, None), ("empty", None)]
    wanted = {"q01": 0.01, "median": 0.5, "q99": 0.99, "top": 1.0}
    got = exact_quantiles(spark.createDataFrame(data, "g string, v double"), "v", wanted, by=["g"], accuracy=accuracy)
    result = {r.g: r for r in got.collect()}
    assert set(result) == {"normal", "ties", "few", None}
    for group, row in result.items():
        values = [v for g, v in data if g == group and v is not None]
        for name, probability in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, probability), abs=1e-9), (group, name)


@pytest.mark.parametrize("accuracy", [3, 10_000])
def test_quantiles_of_hard_data(spark, accuracy):
    """Nearly all values equal, values in order, and so few allowed in a row that ranges are cut again and again."""
    data = [("same", 7.0)] * 4995 + [("same", float(v)) for v in (1, 2, 900, 901, 902)]
    data += [("sorted", float(v)) for v in range(4000)] + [("steep", 2.0**v) for v in range(-500, 500)] + [(None, 1.0)] * 3
    data += [("infinite", v) for v in (float("inf"), float("-inf"), 0.0)]
    wanted = {"q0": 0.0, "q1": 0.0003, "q5": 0.5, "q9": 0.9995, "all": 1.0}
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    out = exact_quantiles(df, "v", wanted, by=["g"], accuracy=accuracy, small=10)
    assert "Window" not in plan(out)
    result = {r.g: r for r in out.collect()}
    assert set(result) == {"same", "sorted", "steep", "infinite", None}
    for group, row in result.items():
        if group == "infinite":
            assert row["q5"] == 0.0 and row["all"] == float("inf")
            continue
        values = [v for g, v in data if g == group]
        for name, probability in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, probability), rel=1e-12), (group, name)


def test_quantiles_where_the_sketch_misses(spark, monkeypatch):
    bounds = quantiles._bounds

    def wrong(*args):
        shifted = F.transform("targets", lambda t: t.withField("low", t["low"] + 40).withField("high", t["high"] + 40))
        return bounds(*args).withColumn("targets", shifted)

    monkeypatch.setattr(quantiles, "_bounds", wrong)
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(df, "v", {"low": 0.25, "median": 0.5}, small=20).first() == (249.75, 499.5)


def test_quantiles_without_groups(spark):
    df = spark.range(1, 102).withColumnRenamed("id", "v")
    assert exact_quantiles(df, "v", {"median": 0.5}).first().median == 51.0


def test_numeric_summary(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "v double")
    assert tuple(numeric_summary(df, "v").first()) == (1.0, 2.0, 3.0, 3.0, 4.0, 5.0)


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = top_per_group(df, ["g"], [F.desc("v")], 2)
    assert rows(top.select("g", "v", "rank")) == [(0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)]
    text = plan(top)
    assert "WindowGroupLimit" in text and text.index("Exchange") < text.index("Partial")


def test_shares_and_totals(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None)], "k string, n int")
    assert rows(share_of_total(df, "n", "pct")) == [("a", 1, 0.25), ("b", 3, 0.75), ("c", None, None)]
    assert rows(with_total(df, "n", "total").select("k", "total")) == [("a", 4), ("b", 4), ("c", 4)]
    zero = spark.createDataFrame([("a", 0)], "k string, n int")
    assert rows(share_of_total(zero, "n", "pct")) == [("a", 0, None)]
    assert "Join" not in optimized(share_of_total(df, "n", "pct"))


@pytest.mark.parametrize("name", ["category_rollup", "checkouts_with_total", "category_share", "traffic_channels"])
def test_totals_do_not_run_the_grouping_again(spark, name):
    """The plan that ran for the total reads what the grouping has shuffled, and no table."""
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    subquery = plan(df).split("== Initial Plan ==")[0]
    assert "Subquery" in subquery and "ReusedExchange" in subquery and "Scan parquet" not in subquery


def test_policy_knows_what_is_behind_a_staged_frame(spark):
    python = spark.range(5).select(F.udf(lambda x: x, "long")("id").alias("x"))
    staged = compute(python)
    later = compute(staged.where("x > 1")).groupBy().count()
    (node,) = udf_report(later)
    assert node.startswith("staged: ") and "EvalPython" in node and node.count("staged") == 1
    with pytest.raises(PythonUdfError):
        compute(later, udf_policy="error")
    assert udf_report(compute(spark.range(5))) == []


def test_rolling_means(spark):
    daily = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 3.0), ("2024-01-12", 8.0)], "d string, v double")
    daily = daily.withColumn("d", F.to_date("d"))
    assert [r.m for r in rolling_mean_rows(daily, "d", "v", "m").orderBy("d").collect()] == [1.0, 2.0, 4.0]
    assert [r.m for r in rolling_mean_days(daily, "d", "v", "m").orderBy("d").collect()] == [1.0, 2.0, 8.0]


def test_frame_difference(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "s string, i int")
    assert frame_difference(a, a).count() == 0
    assert rows(frame_difference(a, b)) == [(1, "x", 1), (3, "y", -1)]
    with pytest.raises(ValueError):
        frame_difference(a, a.drop("s"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "n int, s string")
    assert rows(describe_table(df)) == [("n", 1, "int", 3), ("s", 2, "string", 2)]
    by_name = {r.column_name: r for r in profile(df, approx_distinct=True).collect()}
    assert (by_name["n"].missing, by_name["n"].smallest, by_name["n"].largest) == (0, "1", "2")
    assert by_name["s"].missing == 1 and by_name["s"].mean is None and by_name["s"].distinct_estimate == 1
    assert rows(distinct_profile(df, ["n", "s"])) == [("n", 2, 2), ("s", 1, 2)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 9, 10)] + [(None,)], "v double")
    assert rows(histogram(df, "v", 2)) == [(1, 0.0, 2), (2, 5.0, 3)]
    constant = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    assert rows(histogram(constant, "v", 5)) == [(1, 7.0, 2)]


@pytest.mark.parametrize("mode", ["table", "checkpoint", "cache"])
def test_compute_cuts_off_recomputation(spark, mode):
    kept = compute(spark.range(10).withColumn("r", F.rand()), mode)
    assert rows(kept) == rows(kept)
    assert kept.where("id > 4").count() == 5


def test_collect_is_limited(spark):
    assert len(collect_limited(spark.range(5), 5)) == 5
    with pytest.raises(MemoryError):
        collect_limited(spark.range(6), 5)


def test_udf_policy(spark):
    plain = spark.range(3)
    python = plain.select(F.udf(lambda x: x, "long")("id").alias("x"))
    assert udf_report(plain) == [] and len(udf_report(python)) == 1
    assert apply_policy(python, "ignore") is python
    with pytest.warns(UserWarning):
        apply_policy(python, "warn")
    with pytest.raises(PythonUdfError):
        collect_limited(python, udf_policy="error")
    mapped = plain.mapInPandas(lambda batches: batches, "id long")
    assert len(udf_report(mapped)) == 1
