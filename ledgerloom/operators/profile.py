"""Tables that describe columns: counts, rates, percentiles, histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ratio
from ledgerloom.operators.joins import attach_small
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.operators.ranking import frequencies


def value_counts(df: DataFrame, name: str) -> DataFrame:
    return frequencies(df, name)


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their percentage of all rows with a class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (ratio("n", every) * 100).alias("pct"))


def target_rate(df: DataFrame, name: str, label: str, top: int | None = None) -> DataFrame:
    """Per category: positives, rows with a label and mean label, largest first."""
    out = (
        df.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(
            F.count_if(F.col(label) == 1).alias("hits"),
            F.count(label).alias("total"),
            F.avg(label).alias("avg"),
        )
        .orderBy(F.desc("total"), F.asc(name))
    )
    return out if top is None else out.limit(top)


def percentile_grid(
    df: DataFrame, name: str, percents: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles in rows (by..., pct, value)."""
    found = exact_quantiles(df, name, [p / 100 for p in percents], by)
    return found.select(*by, F.round(F.col("prob") * 100, 6).alias("pct"), "value")


def _bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin from 0; the last bin also holds the maximum."""
    at = F.floor(ratio(value - low, high - low) * bins)
    return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")


def _range_of(df: DataFrame, name: str) -> tuple[Column, Column]:
    value = F.col(name).cast("double")
    found = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    return found["lo"], found["hi"]


def histogram(df: DataFrame, name: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., bin, lo, hi, n) for the bins that hold rows.

    All groups share the bin edges.  A constant column falls into bin 0.
    """
    low, high = _range_of(df, name)
    width = (high - low) / F.lit(bins)
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(*by, _bin_number(F.col(name).cast("double"), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *by,
            "bin",
            (low + width * F.col("bin")).alias("lo"),
            (low + width * (F.col("bin") + 1)).alias("hi"),
            "n",
        )
    )


def density(df: DataFrame, name: str, bins: int, label: str) -> DataFrame:
    """Histogram density per class: the areas of a class add up to 1."""
    counts = histogram(df, name, bins, [label])
    totals = (
        df.where(F.col(name).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_total"))
    )
    return counts.join(totals, label).select(
        label,
        "bin",
        ((F.col("lo") + F.col("hi")) / 2).alias("x"),
        ratio("n", F.col("_total") * (F.col("hi") - F.col("lo"))).alias("density"),
    )


def kernel_density(
    df: DataFrame, name: str, label: str, points: int = 100, cells: int = 1024, cut: float = 3.0
) -> DataFrame:
    """Rows (label, point, x, density): a Gaussian kernel estimate per class.

    The bandwidth is the sample deviation times ``n ** -0.2``; the curve runs ``cut``
    bandwidths beyond the smallest and largest value.  Every value is shared between the
    two nearest nodes of a grid of ``cells`` steps, which keeps its place to first order;
    the kernel is summed over the counted nodes, so the work after one aggregate depends on
    the grid alone.  Classes whose values do not vary have no curve.
    """
    rows = df.where(F.col(name).isNotNull() & F.col(label).isNotNull()).select(
        label, F.col(name).cast("double").alias("_v")
    )
    width = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    spans = (
        rows.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"),
            F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        )
        .where("_sd > 0")
        .select(
            label, "_n", width.alias("_h"),
            (F.col("_lo") - cut * width).alias("_lo"), (F.col("_hi") + cut * width).alias("_hi"),
        )
        .withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(cells)))
    )
    place = (F.col("_v") - F.col("_lo")) / F.col("_step")
    shares = F.array(
        F.struct(F.floor("_at").alias("node"), (1 - F.col("_at") + F.floor("_at")).alias("weight")),
        F.struct((F.floor("_at") + 1).alias("node"), (F.col("_at") - F.floor("_at")).alias("weight")),
    )
    # Two weights per cell merge before the shuffle; at most one row per node and class.
    nodes = (
        attach_small(rows, spans.select(label, "_lo", "_step"), [label])
        .select(label, place.alias("_at"))
        .select(label, F.inline(shares))
        .groupBy(label, "node")
        .agg(F.sum("weight").alias("weight"))
    )
    curve = spans.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / F.lit(float(points - 1))
    )
    away = (F.col("x") - F.col("_lo") - F.col("node") * F.col("_step")) / F.col("_h")
    kernel = F.exp(-0.5 * away * away)
    return (
        curve.join(nodes, label)
        .groupBy(label, "point", "x", "_n", "_h")
        .agg(F.sum(F.col("weight") * kernel).alias("_sum"))
        .select(
            label, "point", "x",
            (F.col("_sum") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"),
        )
    )


def box_stats(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Quartiles, whisker ends within 1.5 quartile ranges, and rows beyond them."""
    by = list(by)
    grid = exact_quantiles(df, name, [0.25, 0.5, 0.75], by)
    boxes = grid.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for n, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75))
        ]
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach)
    values = df.where(F.col(name).isNotNull()).select(*by, F.col(name).cast("double").alias("_v"))
    return (
        attach_small(values, boxes, by)
        .groupBy(*by, "q1", "med", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("lo"),
            F.max(F.when(inside, F.col("_v"))).alias("hi"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(*by, "q1", "med", "q3", "lo", "hi", "outliers")
    )


def describe(df: DataFrame, name: str) -> DataFrame:
    """One row: count, mean, std, min, quartiles, max."""
    value = F.col(name).cast("double")
    grid = exact_quantiles(df, name, [0.25, 0.5, 0.75])
    quartiles = grid.agg(
        F.struct(
            *[
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
            ]
        )
    ).scalar()
    return df.agg(
        F.count(name).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select(
        "count", "mean", "std", "min",
        *[quartiles[q].alias(q) for q in ("p25", "p50", "p75")],
        "max",
    )


def _per_column(df: DataFrame, names: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """One aggregate over all columns, turned into a row per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[e.alias(f"_{c}") for c, e in counts.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("n")) for c in names]
    )
    return wide.select("_rows", F.inline(pairs))


def null_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, nulls) from a single pass over the table."""
    names = list(names or df.columns)
    found = _per_column(df, names, {c: F.count_if(F.col(c).isNull()) for c in names})
    return found.select("column", F.col("n").alias("nulls"))


def flag_shares(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (column, pct0, pct1) of 0/1 columns, in percent with two digits."""
    names = list(names)
    found = _per_column(df, names, {c: F.count_if(F.col(c) == 0) for c in names})
    zeros = F.round(ratio(F.col("n") * 100, "_rows"), 2)
    return found.select("column", zeros.alias("pct0"), F.round(100 - zeros, 2).alias("pct1"))


def relation(df: DataFrame, x: str, y: str, label: str) -> DataFrame:
    """Correlation of two measures per class."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("corr"))


def relation_bins(df: DataFrame, x: str, y: str, label: str, bins: int) -> DataFrame:
    """Rows (label, x_bin, y_bin, n): the picture of a scatter plot."""
    (x_lo, x_hi), (y_lo, y_hi) = _range_of(df, x), _range_of(df, y)
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(
        label,
        _bin_number(F.col(x).cast("double"), x_lo, x_hi, bins).alias("x_bin"),
        _bin_number(F.col(y).cast("double"), y_lo, y_hi, bins).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


def tokens(df: DataFrame, name: str, sep: str = ",") -> DataFrame:
    """One row per part of a separated text."""
    return df.select(F.explode(F.split(F.col(name), sep)).alias("token"))


def token_counts(df: DataFrame, name: str, sep: str = ",") -> DataFrame:
    return frequencies(tokens(df, name, sep), "token")


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns, column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("names"),
    )
