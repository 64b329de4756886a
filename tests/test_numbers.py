import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickwatch.functions import durations
from tickwatch.functions.grading import change_percent, grade
from tickwatch.functions.numbers import as_flag, as_float, as_int, first_text, is_given, round_half_even

TOKENS = {
    "1.5": (1.5, 1),
    '"1.5"': (1.5, None),
    "12.7": (12.7, 12),
    "-12.7": (-12.7, -12),
    '"12"': (12.0, 12),
    '" 7 "': (7.0, 7),
    "1e3": (1000.0, 1000),
    '"1e3"': (1000.0, None),
    "true": (1.0, 1),
    "false": (0.0, 0),
    "null": (None, None),
    '"abc"': (None, None),
    '""': (None, None),
    '"1.5d"': (None, None),
    '"1f"': (None, None),
    '"0x1p3"': (None, None),
    '".5"': (0.5, None),
    '"5."': (5.0, None),
    '"inf"': (math.inf, None),
    '"-Infinity"': (-math.inf, None),
    "[1]": (None, None),
    '{"a": 1}': (None, None),
}


def test_wire_numbers(spark):
    rows = [(token, f'{{"v":{token}}}') for token in TOKENS]
    df = spark.createDataFrame(rows, "token STRING, value STRING")
    v = F.from_json("value", "v VARIANT")["v"]
    got = {r[0]: (r[1], r[2]) for r in df.select("token", as_float(v), as_int(v)).collect()}
    assert got == TOKENS


def test_not_a_number_passes_as_float(spark):
    df = spark.createDataFrame([('{"v":NaN}',), ('{"v":"nan"}',)], "value STRING")
    got = [r[0] for r in df.select(as_float(F.from_json("value", "v VARIANT")["v"])).collect()]
    assert all(math.isnan(x) for x in got)


def test_flags_and_presence(spark):
    texts = ["true", "false", '"t"', '"False"', "1", "0", "2", '"yes"', "null"]
    df = spark.createDataFrame([(f'{{"v":{t}}}',) for t in texts] + [("{}",)], "value STRING")
    v = F.from_json("value", "v VARIANT")["v"]
    got = df.select(as_flag(v), is_given(v)).collect()
    assert [r[0] for r in got] == [True, False, True, False, True, False, None, None, None, None]
    assert [r[1] for r in got] == [True] * 8 + [False, False]


def test_first_text(spark):
    df = spark.createDataFrame([("A", "B"), ("", "B"), (None, "B"), ("", ""), (None, None)], "a STRING, b STRING")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(first_text(a, b)).collect()] == ["A", "B", "B", "", None]
    assert [r[0] for r in df.select(first_text(a, b, default="X")).collect()] == ["A", "B", "B", "X", "X"]


def assert_rounds_like_python(spark, numbers, digits=2):
    df = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE")
    for x, got in df.select("x", round_half_even(F.col("x"), digits)).collect():
        assert got == round(x, digits), x


def test_rounding_ties(spark):
    eighths = [k / 8 for k in range(-4000, 4000)]
    thousandths = [k / 1000 for k in range(-9995, 10000, 5)]
    rates = [(b - a) / a * 100 for a in (7, 20000, 333.3) for b in (a + k * 0.001 for k in range(-300, 300))]
    assert_rounds_like_python(spark, eighths + thousandths + rates)
    assert_rounds_like_python(spark, [k / 16 for k in range(-4000, 4000)], digits=3)


def test_rounding_large_and_random(spark):
    source = random.Random(7)
    numbers = [source.uniform(-1, 1) * 10 ** source.randint(-6, 12) for _ in range(20000)]
    assert_rounds_like_python(spark, numbers + [0.0, 9.99e12, -9.99e12])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=400))
def test_rounding_any(spark, numbers):
    assert_rounds_like_python(spark, numbers)


def test_rounding_keeps_nan_and_null(spark):
    df = spark.createDataFrame([(math.nan,), (None,)], "x DOUBLE")
    got = [r[0] for r in df.select(round_half_even(F.col("x"))).collect()]
    assert math.isnan(got[0]) and got[1] is None


@pytest.mark.parametrize(
    ("rate", "expected"),
    [
        (3.0, "danger"),
        (2.9999999, "warning"),
        (1.0, "warning"),
        (0.9999999, "caution"),
        (0.5, "caution"),
        (0.4999999, "normal"),
        (0.0, "normal"),
        (-0.4999999, "normal"),
        (-0.5, "caution"),
        (-1.0, "warning"),
        (-2.9999999, "warning"),
        (-3.0, "danger"),
        (math.nan, "normal"),
        (math.inf, "danger"),
    ],
)
def test_grades(spark, rate, expected):
    assert spark.range(1).select(grade(F.lit(rate))).first()[0] == expected


def test_change_percent(spark):
    df = spark.createDataFrame([(100.0, 101.0), (0.0, 1.0), (-100.0, -99.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(change_percent(F.col("a"), F.col("b"))).collect()] == [1.0, None, -1.0]


def test_durations():
    assert durations.seconds("5 minutes") == 300
    assert durations.label("1 second") == "1s"
    assert durations.label("1 hour") == "1h"
    assert durations.common_step("5 minutes", "2 minutes") == "60 seconds"


def test_rounding_of_large_numbers(spark):
    source = random.Random(9)
    numbers = [1e13 + 0.125, 4e13 + 7 / 128, -4e13 - 7 / 128, 2.0**46 + 1 / 64, 1e15 + 0.5, -1e16, 1e300, float("inf")]
    numbers += [source.choice([-1, 1]) * source.uniform(1e12, 1e14) for _ in range(3000)]
    numbers += [source.randrange(2**44, 2**47) + source.randrange(128) / 128 for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE")
    for got, x in zip([r[0] for r in df.select(round_half_even(F.col("x"), 2)).collect()], numbers):
        assert got == round(x, 2), x
