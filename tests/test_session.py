"""Sizing of shuffles and splits."""

from eventloom.fixtures import Tables
from eventloom.session import RUNTIME_CONF, fit_to_input, size_in_bytes, tune

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"


def test_settings_grow_with_the_input_and_never_shrink(spark):
    fresh = spark.newSession()
    fit_to_input(fresh, 10 << 20)
    assert fresh.conf.get(INITIAL, None) is None
    fit_to_input(fresh, 1 << 40)
    assert fresh.conf.get(INITIAL) == "8192"
    fit_to_input(fresh, 100 << 40)
    assert fresh.conf.get(INITIAL) == str(100 << 40 >> 27) and fresh.conf.get(SPLIT) == f"{1 << 30}b"
    fit_to_input(fresh, 10 << 20)
    assert fresh.conf.get(INITIAL) == str(100 << 40 >> 27) and fresh.conf.get(SPLIT) == f"{1 << 30}b"


def test_split_between_the_bounds(spark):
    fresh = spark.newSession()
    fit_to_input(fresh, 20 << 40)
    assert 128 << 20 < int(fresh.conf.get(SPLIT)[:-1]) < 1 << 30


def test_size_of_files(spark):
    assert size_in_bytes(Tables(spark, "/root/testdata/sf0.001").base("events")) > 10_000


def test_tune_sets_what_the_library_relies_on(spark):
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.adaptive.enabled", "false")
    tune(fresh)
    assert all(fresh.conf.get(k) == v for k, v in RUNTIME_CONF.items())
