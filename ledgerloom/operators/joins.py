"""Joins of details with statistics of their groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_group_stats(
    df: DataFrame, keys: Sequence[str], stats: dict[str, Column], hot_share: float = 0.001
) -> DataFrame:
    """Add aggregates of a row's group to the row, whatever the group sizes.

    A window over the group would sort it in one task; here the groups are
    pre-aggregated and joined back.  Groups with more than ``hot_share`` of all
    rows, at most ``1 / hot_share`` of them for any data, are looked up by
    broadcast, and their rows, like those with a NULL key, are dealt out over the
    tasks of the second join instead of all landing in one.
    """
    keys, names = list(keys), list(stats)
    grouped = df.groupBy(*keys).agg(
        *[e.alias(n) for n, e in stats.items()], F.count(F.lit(1)).alias("_rows")
    )
    bound = df.agg(F.count(F.lit(1)) * F.lit(hot_share)).scalar()
    hot = grouped.where(F.col("_rows") > bound).select(
        *keys, F.lit(True).alias("_hot"), *[F.col(n).alias(f"_hot_{n}") for n in names]
    )
    # By input task too, so that equal rows do not all meet.
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    unknown = reduce(or_, [F.col(k).isNull() for k in keys])
    dealt = df.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.when(F.col("_hot") | unknown, row_hash).otherwise(0).cast("bigint"),
    )
    # Reading the row count here too lets both uses of the aggregate share one shuffle.
    no_salt = F.when(F.col("_rows") > 0, 0).cast("bigint").alias("_salt")
    cold = grouped.select(*keys, *names, no_salt)
    return dealt.join(cold, [*keys, "_salt"], "left").select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("_hot"), F.col(f"_hot_{n}")).otherwise(F.col(n)).alias(n) for n in names],
    )


def attach_small(df: DataFrame, per_group: DataFrame, keys: Sequence[str], copies: int = 32) -> DataFrame:
    """Add the columns of a table with one row per group, whatever the group sizes.

    Each row of ``per_group`` is copied a few times and the details are dealt over the
    copies, so a hot group is spread over tasks even where the join is shuffled.
    Without keys ``per_group`` is one row, added as values.  Rows without a group go.
    """
    keys = list(keys)
    names = [c for c in per_group.columns if c not in keys]
    if not keys:
        values = per_group.select(F.struct(*names).alias("_s")).scalar()
        return df.withColumns({n: values[n] for n in names})
    numbers = F.sequence(F.lit(0), F.lit(copies - 1))
    copied = per_group.withColumn("_copy", F.explode(numbers))
    dealt = df.withColumn("_copy", F.pmod(F.spark_partition_id(), F.lit(copies)))
    return dealt.join(copied, [*keys, "_copy"]).drop("_copy")


def attach_category_stat(df: DataFrame, category: str, stat: Column, name: str) -> DataFrame:
    """Left join of one statistic per category; an unknown category has none."""
    found = df.where(F.col(category).isNotNull()).groupBy(category).agg(stat.alias(name))
    return df.join(found, category, "left")


def outer_total(left: DataFrame, right: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Full outer join of two per-key tables, missing measures counted as 0."""
    return left.join(right, key, "outer").na.fill(0, subset=list(measures))
