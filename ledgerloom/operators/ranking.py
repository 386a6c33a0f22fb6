"""Sorts, limits, frequencies and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows in a total order; each task keeps only its own n."""
    return df.orderBy(*[F.asc(c) for c in order]).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last n rows in a total order: the first n of the reverse order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def frequencies(df: DataFrame, name: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    out = (
        df.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc(name))
    )
    return out if top is None else out.limit(top)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group in the given order.

    What ``row_number() = 1`` gives, as an aggregate that merges before the
    shuffle instead of a sort of the whole group in one task.
    """
    row = F.struct(*df.columns)
    rank = F.struct(*order, *[c for c in df.columns if c not in order])
    return df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row")).select("_row.*")
