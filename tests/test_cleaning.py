from pyspark.sql import functions as F

from ledgerloom.operators import cleaning
from tables import rows


def test_null_where(spark):
    df = spark.createDataFrame([(1, 365243), (2, -10), (3, None)], "id int, d int")
    out = rows(cleaning.null_where(df, {"d": F.col("d") > 0}), "id")
    assert [r["d"] for r in out] == [None, -10, None]


def test_null_maximum_per_column_and_everywhere(spark):
    df = spark.createDataFrame([(1, 9, 4), (2, 3, 9), (3, None, 1)], "id int, a int, b int")
    out = rows(cleaning.null_maximum(df, ["a", "b"]), "id")
    assert [(r["a"], r["b"]) for r in out] == [(None, 4), (3, None), (None, 1)]
    out = rows(cleaning.null_maximum_everywhere(df, "a"), "id")
    assert [(r["a"], r["b"]) for r in out] == [(None, 4), (3, None), (None, 1)]


def test_fill_passes_over_other_kinds(spark):
    df = spark.createDataFrame([(None, None)], "name string, flag int")
    out = cleaning.fill_nulls(df, {"name": "none", "flag": "none", "absent": 0}).first()
    assert (out["name"], out["flag"]) == ("none", None)


def test_mode_ignores_null_and_takes_the_smallest_on_a_tie(spark):
    data = [(None,), (None,), (None,), (4,), (4,), (2,), (2,), (1,)]
    df = spark.createDataFrame(data, "n int")
    assert cleaning.most_frequent(df, "n").first()["n"] == 2
    filled = [r["n"] for r in cleaning.fill_most_frequent(df, "n").collect()]
    assert filled.count(2) == 5 and None not in filled


def test_replace_keeps_null(spark):
    df = spark.createDataFrame([("XNA",), ("F",), (None,)], "g string")
    out = cleaning.replace_values(df, {"g": {"XNA": "M"}})
    assert [r["g"] for r in out.collect()] == ["M", "F", None]


def test_fill_all_numeric_spares_the_key(spark):
    df = spark.createDataFrame([(None, None, None)], "id int, x double, t string")
    out = cleaning.fill_all_numeric(df, keep=["id"]).first()
    assert (out["id"], out["x"], out["t"]) == (None, 0.0, None)
