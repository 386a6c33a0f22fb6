import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import columns
from ledgerloom.operators.encoding import (
    category_pairs,
    category_rows,
    fit_categories,
    index_values,
    one_hot,
    sparse_rows,
)


def test_first_of_each_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").select(
        "a", "b", F.col("c").alias("A"), F.col("c").alias("b")
    )
    out = columns.first_of_each_name(df)
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, 2)


def test_join_suffix_only_on_collision(spark):
    left = spark.createDataFrame([(1, 5)], "k int, n int")
    right = spark.createDataFrame([(1, 7, 8)], "k int, n int, m int")
    out = columns.join_with_suffix(left, right, "k", "_year")
    assert out.columns == ["k", "n", "n_year", "m"]


def test_narrow_types_bounds_are_open(spark):
    df = spark.createDataFrame(
        [(126, 127, 2**40, 1.5, None)], "a bigint, b bigint, c bigint, d double, e int"
    )
    found = dict(columns.narrow_types(df).dtypes)
    assert found == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float", "e": "int"}


def test_align(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = columns.align_columns(df, ["b", "z"])
    assert out.columns == ["b", "z"] and tuple(out.first()) == (2, 0)


def test_one_hot_learned_once(spark):
    train = spark.createDataFrame([("a/b",), ("a b",), ("A-B",), (None,)], "c string")
    categories = fit_categories(train)
    test = spark.createDataFrame([("a/b",), ("new",), (None,)], "c string")
    out = one_hot(test, categories, null_column=True)
    # Three values become the same name; the later ones are numbered.
    assert out.columns == ["c_A_B", "c_a_b_2", "c_a_b_3", "c_nan"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 1)]


def test_one_hot_sums_to_one(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    out = one_hot(df, fit_categories(df))
    assert [sum(r) for r in out.collect()] == [1, 1, 1]


def test_a_column_beyond_its_limit_is_left_out_and_named(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"), F.lit("x").alias("d"), F.lit(None).cast("string").alias("e"))
    assert fit_categories(df, limits=10) == {"d": ["x"], "e": []}
    assert fit_categories(df, limits={"c": 20, "d": 0})["c"] == sorted(map(str, range(20)))
    wide = category_rows(df, limits={"c": 19}).where("value IS NULL").collect()
    assert [(r["name"], r["values"]) for r in wide] == [("c", 20)]


def test_one_hot_none_columns_are_zero(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    out = one_hot(df, fit_categories(df), null_column=True, none_column=True)
    assert out.columns == ["c_x", "c_nan", "c_None"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 1, 0)]


def test_sparse_rows_equal_one_hot(spark):
    train = spark.createDataFrame([(1, "a", "p"), (2, "b", None), (3, None, "q"), (4, "a", "q")], "id int, c string, d string")
    test = spark.createDataFrame([(7, "b", "q"), (8, "unseen", None), (9, None, None)], "id int, c string, d string")
    index = index_values(category_pairs(train, ["c", "d"]))
    place = {(r["name"], r["value"]): r["position"] for r in index.collect()}
    assert sorted(place.values()) == [0, 1, 2, 3] and {place["c", v] for v in "ab"} == {0, 1}
    got = {r["id"]: r for r in sparse_rows(test, "id", index, ["c", "d"]).collect()}
    assert got[7]["indices"] == sorted([place["c", "b"], place["d", "q"]]) and got[7]["values"] == [1.0, 1.0]
    assert got[8]["indices"] == got[9]["indices"] == [] and {r["size"] for r in got.values()} == {4}


def test_a_million_values_are_no_columns(spark):
    df = spark.range(1_000_000, numPartitions=8).select(
        "id", F.concat(F.lit("v"), "id").alias("c"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("d"))
    assert fit_categories(df, ["c", "d"]) == {"d": ["cold", "hot"]}
    index = index_values(category_pairs(df, ["c", "d"]))
    found = index.agg(F.count("*"), F.count_distinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(found) == (1_000_002, 1_000_002, 0, 1_000_001)
