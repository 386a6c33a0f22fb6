"""Null, sentinel and category repair.

Statistics that a repair needs (a column maximum, a mode) are scalar subqueries:
one small aggregate inside the same plan, nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.columns import numeric_columns


def null_where(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Set a column to NULL in the rows where its rule holds."""
    return df.withColumns(
        {c: F.when(rule, F.lit(None)).otherwise(F.col(c)) for c, rule in rules.items()}
    )


def null_maximum(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Treat the largest value of each column as its "unknown" marker."""
    names = list(names)
    top = df.agg(F.struct(*[F.max(c).alias(c) for c in names])).scalar()
    return df.withColumns({c: F.nullif(F.col(c), top[c]) for c in names})


def null_maximum_everywhere(df: DataFrame, name: str) -> DataFrame:
    """Take the largest value of one column as "unknown" in all numeric columns."""
    top = df.agg(F.max(name)).scalar()
    return df.withColumns({c: F.nullif(F.col(c), top) for c in numeric_columns(df)})


def zero_to_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in names})


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs, but only where the value is of the column's kind.

    A text default for a numeric column, or the reverse, leaves it untouched;
    columns the table does not have are passed over.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}

    def fits(name: str, value) -> bool:
        kind = kinds.get(name.lower())
        if isinstance(value, str):
            return isinstance(kind, T.StringType)
        return isinstance(kind, T.NumericType)

    usable = {c: v for c, v in values.items() if fits(c, v)}
    return df.na.fill(usable) if usable else df


def replace_values(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Replace values, ``{column: {old: new}}``; NULL stays NULL."""
    out = {}
    for c, pairs in rules.items():
        expr = F.col(c)
        for old, new in pairs.items():
            expr = F.when(F.col(c) == F.lit(old), F.lit(new)).otherwise(expr)
        out[c] = expr
    return df.withColumns(out)


def most_frequent(df: DataFrame, name: str) -> DataFrame:
    """One row: the most frequent non-null value, the smallest one on a tie."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .orderBy(F.desc("_rows"), F.asc(name))
        .limit(1)
        .select(name)
    )


def fill_most_frequent(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(name), most_frequent(df, name).scalar()))


def fill_all_numeric(df: DataFrame, value: float = 0, keep: Iterable[str] = ()) -> DataFrame:
    """Fill NULLs of every numeric column but those in ``keep``."""
    keep = set(keep)
    return df.na.fill(value, subset=[c for c in numeric_columns(df) if c not in keep])
