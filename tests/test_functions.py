import datetime as dt

from pyspark.sql import functions as F

from shelfline.functions import calendar_columns, money, number, parse_day, quantity, ratio, round2, whole


def values(spark, rows, ddl, expr):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_parse_day_accepts_one_form_only(spark):
    texts = ["2025-01-05", "2", "2025", "2025-1-5", "2025-02-29", "2025-01-05 00:00:00", " 2025-01-5", "2025-01-5 ", None]
    got = values(spark, [(t,) for t in texts], "t string", parse_day(F.col("t")))
    assert got == [dt.date(2025, 1, 5)] + [None] * 8


def test_parse_day_rejects_trailing_newline(spark):
    assert values(spark, [("2025-01-05\n",)], "t string", parse_day(F.col("t"))) == [None]


def test_quantity_defaults_to_zero(spark):
    got = values(spark, [("1.5",), (None,), ("abc",), ("",)], "t string", quantity(F.col("t")))
    assert got == [1.5, 0.0, 0.0, 0.0]


def test_round_half_up_through_decimal(spark):
    got = values(spark, [(1.005,), (-1.005,), (2.675,), (None,), (float("nan"),)], "x double", round2(F.col("x")))
    assert got == [1.01, -1.01, 2.68, None, None]


def test_money_keeps_two_places(spark):
    assert [str(v) for v in values(spark, [(1.005,), (7.0,)], "x double", money(F.col("x")))] == ["1.01", "7.00"]


def test_ratio_is_null_on_zero(spark):
    got = values(spark, [(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double", ratio(F.col("a"), F.col("b")))
    assert got == [None, None, 0.25]


def test_calendar_names_are_full_english(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 3),)], "d date").select(
        *[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]
    )
    assert df.first().asDict() == {
        "year": 2025,
        "quarter": 3,
        "month": 9,
        "month_name": "September",
        "day": 3,
        "day_of_week": "Wednesday",
    }


def test_missing_is_zero_and_unreadable_is_null(spark):
    texts = [(None,), ("",), (" ",), ("1.5",), ("abc",), ("NaN",), ("1,234.50",), ("Infinity",), ("-3",)]
    assert values(spark, texts, "t string", number(F.col("t"))) == [0.0, 0.0, 0.0, 1.5, None, None, None, None, -3.0]
    assert values(spark, [("12.0",), ("12.5",), ("7",), (None,), ("x",)], "t string", whole(F.col("t"))) == [12, None, 7, 0, None]
