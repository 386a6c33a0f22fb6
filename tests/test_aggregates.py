import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates as ag
from ledgerloom.operators.joins import attach_category_stat, attach_group_stats
from ledgerloom.operators.ranking import first_row
from tables import rows


def test_scope_without_rows_is_null_but_unknown_sum_is_zero(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", 2.0), (2, "b", 3.0)], "id int, s string, x double"
    )
    spec = {"x": ["sum", "size", "max", "mean", "count", "nunique", "var"]}
    out = rows(df.groupBy("id").agg(*ag.measures(spec, "a_", "s = 'a'")), "id")
    assert (out[0]["a_x_sum"], out[0]["a_x_size"], out[0]["a_x_max"]) == (0.0, 1, None)
    assert (out[0]["a_x_count"], out[0]["a_x_nunique"]) == (0, 0)
    assert all(out[1][f"a_x_{f}"] is None for f in spec["x"])


def test_shares_quote_values(spark):
    df = spark.createDataFrame([(1, "it's"), (1, "b\\c"), (1, None), (1, "it's")], "id int, s string")
    out = df.groupBy("id").agg(*ag.category_shares({"s": ["it's", "b\\c"]})).first()
    assert (out["s_it_s_mean"], out["s_b_c_mean"], out["s_nan_mean"]) == (0.5, 0.25, 0.25)


def test_first_and_last_known(spark):
    data = [(1, -3, None), (1, -2, 7), (1, -1, 9), (1, 0, None), (1, -2, 5), (2, 0, None), (3, -1, -4)]
    df = spark.createDataFrame(data, "id int, m int, v int")
    out = rows(
        df.groupBy("id").agg(ag.first_known("v", "m").alias("f"), ag.last_known("v", "m").alias("l")),
        "id",
    )
    assert [(r["f"], r["l"]) for r in out] == [(5, 9), (None, None), (-4, -4)]


def test_first_and_last_known_keep_their_type(spark):
    data = [(1, 1, 3_000_000_000, 2.75), (1, 2, 5, -5.5), (1, 2, -7, None)]
    df = spark.createDataFrame(data, "id int, m int, b bigint, x double")
    out = df.groupBy("id").agg(
        *[f(c, "m").alias(n + c) for c in "bx" for n, f in (("f", ag.first_known), ("l", ag.last_known))]
    )
    assert tuple(out.first()) == (1, 3_000_000_000, 5, 2.75, -5.5)
    assert [t for _, t in out.dtypes[1:]] == ["bigint", "bigint", "double", "double"]


def test_lookbacks_refuse_windows_out_of_order():
    with pytest.raises(ValueError):
        ag.Lookbacks("d", (("_week", 7), ("", None)))


def test_group_stats_deal_out_null_keys(spark):
    df = spark.range(20_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("k"), "id")
    out = attach_group_stats(df, ["k"], {"n": F.count("id")})
    spread = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert out.count() == 20_000 and spread[0] < 2 * 20_000 / spread[1]


def test_lookbacks_equal_one_filter_per_window(spark):
    rnd = random.Random(3)
    data = [
        (rnd.randrange(6), -rnd.choice([0, 6, 7, 8, 14, 15, 30, 90, 182, 365, 366, 900]), rnd.random())
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "id int, d int, x double")
    windows = ag.Lookbacks("d", ag.DAY_WINDOWS)
    spec = {"x": ["max", "mean", "sum", "var", "size", "nunique"]}
    long = windows.expand(df).groupBy("id", ag.LOOKBACK).agg(*ag.measures(spec))
    wide = rows(windows.widen(long, "id"), "id")
    for suffix, reach in ag.DAY_WINDOWS:
        part = df if reach is None else df.where(F.col("d") >= -reach)
        want = {r["id"]: r for r in part.groupBy("id").agg(*ag.measures(spec)).collect()}
        for row in wide:
            for f in spec["x"]:
                got = row[f"x_{f}{suffix}"]
                expected = want[row["id"]][f"x_{f}"] if row["id"] in want else None
                assert got == expected or abs(got - expected) < 1e-9
    sizes = [[row[f"x_size{s}"] or 0 for s, _ in ag.DAY_WINDOWS] for row in wide]
    assert all(s == sorted(s, reverse=True) for s in sizes)


def test_rows_without_offset_count_only_in_the_open_window(spark):
    df = spark.createDataFrame([(1, None), (1, -5)], "id int, d int")
    windows = ag.Lookbacks("d", (("", None), ("_week", 7)))
    got = windows.expand(df).groupBy(ag.LOOKBACK).count().collect()
    assert {r[ag.LOOKBACK]: r["count"] for r in got} == {0: 2, 1: 1}
    closed = ag.Lookbacks("d", (("_week", 7), ("_day", 1)))
    assert closed.expand(df).count() == 1


def test_group_stats_with_a_hot_key_and_copies(spark):
    """One key holds most rows, many of them equal; NULL keys have no statistics."""
    data = [(1, 5)] * 600 + [(k, k % 7) for k in range(2, 300) for _ in range(2)] + [(None, 1)]
    df = spark.createDataFrame(data, "k int, v int")
    out = attach_group_stats(df, ["k"], {"s": F.sum("v"), "n": F.count("v")}, hot_share=0.05)
    window = Window.partitionBy("k")
    want = df.withColumn("s", F.sum("v").over(window)).withColumn("n", F.count("v").over(window))
    known = F.col("k").isNotNull()
    assert sorted(map(tuple, out.where(known).collect())) == sorted(
        map(tuple, want.where(known).collect())
    )
    assert out.where(~known).collect()[0]["s"] is None
    assert out.count() == len(data)


def test_category_stat_keeps_rows_of_unknown_category(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0)], "c string, x double")
    out = rows(attach_category_stat(df, "c", F.max("x"), "top"), "x")
    assert [r["top"] for r in out] == [3.0, 3.0, None]


def test_first_row(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 2, "z"), (1, 2, "a"), (2, 5, None)], "k int, o int, v string")
    assert [tuple(r.values()) for r in rows(first_row(df, ["k"], ["o"]), "k")] == [(1, 2, "a"), (2, 5, None)]
