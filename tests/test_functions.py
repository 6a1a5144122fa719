import datetime

import pytest
from pyspark.sql import functions as F

from starmart import functions as fn


def values(spark, kind, data, expression):
    frame = spark.createDataFrame([(v,) for v in data], f"x {kind}")
    return [r[0] for r in frame.select(expression(F.col("x")).alias("y")).collect()]


def test_sas_dates(spark):
    days = [0.0, 20454.0, 20484.9, -1.0, -0.5, None, float("nan"), 1e12]
    assert values(spark, "double", days, fn.sas_day) == [1, 1, 31, 31, 31, None, None, None]
    assert values(spark, "double", [20454.0], fn.sas_date) == [datetime.date(2016, 1, 1)]


def test_admission_number(spark):
    texts = ["92478490733.0", "123", ".5", "", "1.2.3", None]
    expected = ["92478490733", "123", "", "", "1", None]
    assert values(spark, "string", texts, fn.admission_number) == expected


@pytest.mark.parametrize(
    ("age", "group"),
    [(-3, 1), (0, 1), (25, 1), (26, 2), (35, 2), (36, 3), (45, 3), (46, 4), (59, 4), (60, 5), (101, 5)],
)
def test_age_group(spark, age, group):
    assert values(spark, "int", [age], fn.age_group) == [group]


def test_age_group_of_nothing(spark):
    assert values(spark, "int", [None], fn.age_group) == [None]


def test_age(spark):
    years = [1991, None, -2147483648]
    assert values(spark, "int", years, lambda x: fn.age_in_year(F.lit(2016), x)) == [25, None, None]


def test_casts(spark):
    numbers = [12.9, -12.9, float("nan"), 3e9, -3e9, float("inf"), None]
    assert values(spark, "double", numbers, fn.as_integer) == [12, -12, *[None] * 5]
    edges = [2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0]
    assert values(spark, "double", edges, fn.as_integer) == [2147483647, None, -2147483648, None]
    assert values(spark, "double", [1e19, -1e19, float("nan")], fn.key_text) == [None] * 3
    assert values(spark, "double", [1.0, 3e9, None], fn.key_text) == ["1", "3000000000", None]
    assert values(spark, "int", [7, None], fn.as_label) == ["7", None]


def test_round_half_even(spark):
    assert values(spark, "double", [2.5, 3.5, 2.51, -2.5], fn.round_half_even) == [2, 4, 3, -2]


def test_text_values(spark):
    assert values(spark, "string", ["a", "", None], fn.is_present) == [True, False, False]
    filled = values(spark, "string", ["a", "", None], lambda x: fn.fill_unknown(x, "U"))
    assert filled == ["a", "", "U"]


def test_periods(spark):
    following = values(spark, "int", [1, 12], lambda m: fn.following_period(F.lit(2016), m))
    assert [tuple(p) for p in following] == [(2016, 2), (2017, 1)]
    keys = values(spark, "int", [1, 12, None], lambda m: fn.month_key(F.lit(2016), m))
    assert keys == ["1_2016", "12_2016", None]
    assert values(spark, "int", [2016, 2007], fn.short_year) == ["16", "07"]
    names = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    assert values(spark, "int", list(range(1, 13)), fn.month_name) == names
