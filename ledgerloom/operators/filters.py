"""Row filters: thresholds, categories, look-back windows, classes, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def above(df: DataFrame, name: str, bound: float = 0) -> DataFrame:
    return df.where(F.col(name) > bound)


def counts_above(df: DataFrame, name: str, bounds: list[float], by: list[str]) -> DataFrame:
    """For several thresholds at once: rows above each, beside all rows."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(name) > b).alias(f"above_{b}") for b in bounds],
    )


def in_category(df: DataFrame, name: str, value) -> DataFrame:
    return df.where(F.col(name) == F.lit(value))


def within(df: DataFrame, offset: str, reach: int) -> DataFrame:
    """Rows at most ``reach`` units before the application (offsets are negative)."""
    return df.where(F.col(offset) >= -reach)


def split_by_class(df: DataFrame, label: str, values=(0, 1)) -> list[DataFrame]:
    return [df.where(F.col(label) == v) for v in values]


def by_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def row_count(df: DataFrame, condition: Column) -> DataFrame:
    """One row with the number of rows that meet a condition."""
    return df.agg(F.count_if(condition).alias("n"))
