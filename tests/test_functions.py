"""Column expressions: cleaning, numbers in text, distance, timezone-free seconds."""

import datetime as dt
import math

import pytest

from sousflow.functions import (
    clean_lower, clean_upper, concat_name, epoch_seconds, great_circle_m, int_from_unit_text,
    prefix_before, round_to_int, seconds_between, strip_quotes,
)
from sousflow.functions.geo import METRES_PER_MILE


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_clean_trims_spaces_not_tabs(spark):
    out = one(spark, clean_lower("s"), [("  Chicago ",), ("\tChicago",), (None,)], "s string")
    assert out == ["chicago", "\tchicago", None]
    assert one(spark, clean_upper("s"), [(" il ",)], "s string") == ["IL"]


def test_strip_quotes_and_prefix(spark):
    assert one(spark, strip_quotes("s"), [('"12"',)], "s string") == ["12"]
    got = one(spark, prefix_before("s"), [("flour, white",), ("lemon",), (",x",), (None,)], "s string")
    assert got == ["flour", "", "", None]


def test_int_from_unit_text(spark):
    got = one(spark, int_from_unit_text("s"), [("12g",), ("1.5g",), ("2.5g",), ("abc",), (None,)], "s string")
    assert got == [12, 2, 3, None, None]


def test_round_to_int_half_away(spark):
    assert one(spark, round_to_int("x"), [(2.5,), (-2.5,), (2.4,)], "x double") == [3, -3, 2]


def test_concat_name_null(spark):
    assert one(spark, concat_name("a", "b"), [("Ann", "Lee"), (None, "Lee")], "a string, b string") == ["Ann Lee", None]


def test_great_circle_known_pair(spark):
    miles = one(spark, great_circle_m("a", "b", "c", "d") / METRES_PER_MILE,
                [(41.8781, -87.6298, 41.6020, -87.3371)], "a double, b double, c double, d double")[0]
    assert miles == pytest.approx(24.3288, abs=1e-3)
    assert one(spark, great_circle_m("a", "b", "a", "b"), [(10.0, 20.0)], "a double, b double") == [0.0]
    assert one(spark, great_circle_m("a", "b", "a", "b"), [(None, 20.0)], "a double, b double") == [None]
    antipode = one(spark, great_circle_m("a", "b", "c", "d"), [(0.0, 0.0, 0.0, 180.0)],
                   "a double, b double, c double, d double")[0]
    assert antipode == pytest.approx(math.pi * 6371008.8, rel=1e-12)


def test_seconds_are_timezone_free(spark):
    # 2024-03-10 is a DST change in the session zone (America/New_York): 2 h must stay 7200 s.
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 0, 0, 900000), dt.datetime(2024, 3, 10, 3, 0, 1, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    row = df.select(epoch_seconds("a").alias("sa"), epoch_seconds("b").alias("sb")).first()
    assert row.sa == 1710032400
    assert row.sb - row.sa == 7201  # second boundaries crossed, not elapsed whole seconds
    before = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 500000),)], "a timestamp_ntz")
    assert before.select(epoch_seconds("a")).first()[0] == -1
    assert df.select(seconds_between(epoch_seconds("a"), epoch_seconds("b"))).first()[0] == 7201
