import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as sc


def one(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_ratio_never_raises(spark):
    df = one(spark, "a double, b double", (1.0, 4.0), (1.0, 0.0), (None, 2.0), (0.0, 0.0))
    assert values(df, sc.ratio("a", "b")) == [0.25, None, None, None]


def test_total_needs_every_value(spark):
    df = one(spark, "a double, b double", (1.0, 2.0), (1.0, None))
    assert values(df, sc.total("a", "b")) == [3.0, None]


def test_dates(spark):
    day = dt.date(2024, 3, 31)
    df = one(spark, "d date, n int", (day, -1))
    assert values(df, sc.date_key("d")) == [20240331]
    assert values(df, sc.month_label("d")) == ["2024-03"]
    assert values(df, sc.month_of_key(sc.date_key("d"))) == ["202403"]
    assert values(df, sc.shift_months("d", "n")) == [dt.date(2024, 2, 29)]
    assert values(df, sc.shift_days("d", F.lit("no number"))) == [None]


def test_clipping_keeps_null(spark):
    df = one(spark, "a int", (-3,), (0,), (5,), (None,))
    assert values(df, sc.at_least_zero("a")) == [0, 0, 5, None]
    assert values(df, sc.is_positive("a")) == [0, 0, 1, 0]
    assert values(df, sc.reaches("a", 5)) == [0, 0, 1, 0]


def test_yes_no_and_decode(spark):
    df = one(spark, "a string", ("Y",), ("N",), ("1",), ("maybe",), (None,))
    assert values(df, sc.yes_no("a")) == [1, 0, 1, None, None]
    assert values(df, sc.decode("a", {"Y": 1, "N": 2}, 9)) == [1, 2, 9, 9, 9]
    assert values(df, sc.matches("a", "Y")) == [1, 0, 0, 0, 0]


def test_settled_rounds_ties_up(spark):
    df = one(spark, "a double", (0.125 + 1e-16,), (0.125 - 1e-17,), (1.005,))
    assert values(df, sc.settled(F.col("a"), 2)) == [0.13, 0.13, 1.01]


def test_whole_years(spark):
    df = one(spark, "a int", (-364,), (-365,), (-731,), (None,))
    assert values(df, sc.whole_years_ago("a")) == [0, 1, 2, None]
