import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.profile import box_stats, describe, histogram, kernel_density, percentile_grid
from ledgerloom.operators import quantiles
from ledgerloom.operators.joins import attach_small
from ledgerloom.operators.quantiles import exact_quantiles, running_sums


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_against_numpy(spark, size):
    rng = np.random.default_rng(size)
    groups = {g: np.round(rng.exponential(50, size), 1) for g in ("a", "b")}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0, 0.05, 0.25, 0.5, 0.75, 0.99, 1]
    out = exact_quantiles(df, "x", probs, ["g"]).collect()
    assert len(out) == 2 * len(probs)
    for r in out:
        assert r["value"] == pytest.approx(np.quantile(groups[r["g"]], r["prob"]))


def test_one_value_holds_most_rows(spark):
    values = [7.0] * 900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in percentile_grid(df, "x", [0, 5, 50, 95, 99.9, 100]).collect():
        assert r["value"] == pytest.approx(np.percentile(values, r["pct"]))


def test_histogram_against_numpy(spark):
    values = [0, 1, 1, 2, 5, 9, 10, 10, 3]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x int")
    got = {r["bin"]: r["n"] for r in histogram(df, "x", 5).collect()}
    want, _ = np.histogram(values, 5)
    assert got == {i: n for i, n in enumerate(want) if n}


def test_constant_column(spark):
    df = spark.createDataFrame([(4,), (4,)], "x int")
    assert [(r["bin"], r["n"]) for r in histogram(df, "x", 5).collect()] == [(0, 2)]


def test_describe_and_box(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    d = describe(df, "x").first()
    assert (d["count"], d["mean"], d["min"], d["p50"], d["max"]) == (5, 22.0, 1.0, 3.0, 100.0)
    b = box_stats(df, [], "x").first()
    assert (b["q1"], b["q3"], b["lo"], b["hi"], b["outliers"]) == (2.0, 4.0, 1.0, 4.0, 1)


def test_many_distinct_values_and_a_hot_group(spark):
    """No window gets more than a small part of a group, and the result is exact."""
    n = 200_000
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("x")
    )
    values = {g: [float(i * 7919 % n) for i in range(n) if (i % 10 < 9) == (g == "hot")] for g in ("hot", "cold")}
    probs = [0.001, 0.25, 0.5, 0.9]
    for r in exact_quantiles(df, "x", probs, ["g"]).collect():
        assert r["value"] == pytest.approx(np.quantile(values[r["g"]], r["prob"]))
    for r in exact_quantiles(df, "x", probs).collect():
        assert r["value"] == pytest.approx(np.quantile(values["hot"] + values["cold"], r["prob"]))


def test_plan_without_groups_has_no_nested_loop(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    out = exact_quantiles(df, "x", [0.5])
    out.collect()
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", [1, 3, 64, 100])
def test_range_number(spark, monkeypatch, step):
    monkeypatch.setattr(quantiles, "STEP", step)
    cuts = sorted({float(c) for c in random.Random(step).sample(range(300), 130)})
    for given in ([], cuts[:1], cuts[:64], cuts[:65], cuts):
        df = spark.range(-2, 305).select(F.col("id").cast("double").alias("v"), F.lit(given).cast("array<double>").alias("cuts"))
        got = df.select("v", quantiles.range_number("cuts", "v").alias("n")).collect()
        assert all(r["n"] == sum(c <= r["v"] for c in given) for r in got)


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "RANGES", 7)
    rnd = random.Random(1)
    data = [(rnd.choice("aab"), float(rnd.choice([5, 5, 5, rnd.randrange(60)])), rnd.randrange(4)) for _ in range(900)]
    df = spark.createDataFrame(data + [("a", None, 3), (None, 1.0, 1)], "g string, v double, n int").repartition(6)
    sums = Counter()
    for g, v, n in data:
        sums[g, v] += n
    got = {(r["g"], r["v"]): (r["n"], r["n_before"]) for r in running_sums(df, "v", ["n"], ["g"]).collect()}
    assert got == {(g, v): (n, sum(m for (h, w), m in sums.items() if h == g and w < v)) for (g, v), n in sums.items()}
    whole = {r["v"]: r["n_before"] for r in running_sums(df.where("g is not null"), "v", ["n"]).collect()}
    assert whole == {v: sum(m for (_, w), m in sums.items() if w < v) for _, v in sums}


def test_attach_small_spreads_a_hot_group(spark):
    df = spark.range(20_000, numPartitions=16).select(F.lit("hot").alias("g"), "id")
    small = spark.createDataFrame([("hot", 7), ("none", 8)], "g string, s int")
    off = {"autoBroadcastJoinThreshold": "-1", "adaptive.enabled": "false"}
    for name, value in off.items():
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        out = attach_small(df, small, ["g"])
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in off:
            spark.conf.unset(f"spark.sql.{name}")
    assert sum(per_task) == 20_000 and max(per_task) < 15_000
    assert out.agg(F.min("s"), F.max("s"), F.count("s")).first() == (7, 7, 20_000)


def test_kernel_density_equals_a_plain_evaluation(spark):
    rng = np.random.default_rng(4)
    values = {0: rng.normal(50, 9, 3000), 1: rng.exponential(20, 2000)}
    data = [(k, float(v)) for k, vs in values.items() for v in vs] + [(2, 5.0), (2, 5.0), (3, 1.0), (None, 2.0), (0, None)]
    df = spark.createDataFrame(data, "y int, x double").repartition(5)
    found = kernel_density(df, "x", "y", points=60).collect()
    assert {r["y"] for r in found} == {0, 1} and len(found) == 120
    for label, vs in values.items():
        h = vs.std(ddof=1) * len(vs) ** -0.2
        got = sorted((r["x"], r["density"]) for r in found if r["y"] == label)
        x = np.array([g[0] for g in got])
        assert np.allclose([x[0], x[-1]], [vs.min() - 3 * h, vs.max() + 3 * h])
        want = np.exp(-0.5 * ((x[:, None] - vs) / h) ** 2).sum(1) / (len(vs) * h * np.sqrt(2 * np.pi))
        # Sharing a value between two nodes widens the kernel by the step squared over six at most.
        assert np.abs(want - [g[1] for g in got]).max() < 1e-3 * want.max()
        assert np.trapezoid([g[1] for g in got], x) == pytest.approx(1, abs=0.01)
