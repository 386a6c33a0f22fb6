"""Projection and schema operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)

# Open bounds within which a column is stored in the narrower type.
INTEGER_BOUNDS = (
    ("byte", -(2**7), 2**7 - 1),
    ("short", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
)
FLOAT_BOUND = 3.4028234663852886e38


def project(df: DataFrame, names: Mapping[str, str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Select ``{source: new name}``, cast where ``types`` (by new name) says so."""
    types = types or {}
    out = []
    for source, name in names.items():
        column = F.col(source)
        if name in types:
            column = column.try_cast(types[name])
        out.append(column.alias(name))
    return df.select(*out)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast; text that does not read as the type becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def suffix_columns(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Add a suffix to every column but the keys, so that a join cannot collide."""
    keep = {k.lower() for k in keep}
    return df.select(
        *[F.col(c) if c.lower() in keep else F.col(c).alias(c + suffix) for c in df.columns]
    )


def join_with_suffix(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left join; only right columns that also exist on the left get the suffix."""
    taken = {c.lower() for c in left.columns} - {key.lower()}
    renamed = right.select(
        *[F.col(c).alias(c + suffix) if c.lower() in taken else F.col(c) for c in right.columns]
    )
    return left.join(renamed, key, "left")


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    seen: set[str] = set()
    positions = []
    for i, name in enumerate(df.columns):
        if name.lower() not in seen:
            seen.add(name.lower())
            positions.append(i)
    if len(positions) == len(df.columns):
        return df
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{i}").alias(df.columns[i]) for i in positions])


def columns_matching(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part.lower() in c.lower()]


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, *INTEGER_TYPES, *FLOAT_TYPES)


def safe_name(value) -> str:
    """A value as part of a column name: anything unusual becomes an underscore."""
    return re.sub(r"\W", "_", str(value), flags=re.ASCII)


def distinct_names(names: Sequence[str]) -> list[str]:
    """Number the later ones of names that are equal but for case."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen[name.lower()] = seen.get(name.lower(), 0) + 1
        out.append(name if n == 1 else f"{name}_{n}")
    return out


def align_columns(df: DataFrame, wanted: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly the wanted columns in order; missing ones are constant."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[F.col(c) if c.lower() in have else F.lit(fill).alias(c) for c in wanted]
    )


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numeric columns to the smallest type their values fit in.

    One aggregate job finds all ranges; the casts are a plain projection.
    """
    names = numeric_columns(df)
    if not names:
        return df
    found = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in names], *[F.max(c).alias(f"hi_{c}") for c in names]
    ).first()
    integers = set(columns_of_type(df, *INTEGER_TYPES))
    casts: dict[str, Column] = {}
    for c in names:
        lo, hi = found[f"lo_{c}"], found[f"hi_{c}"]
        if lo is None:
            continue
        if c in integers:
            fit = next((t for t, low, high in INTEGER_BOUNDS if lo > low and hi < high), "bigint")
        else:
            fit = "float" if lo > -FLOAT_BOUND and hi < FLOAT_BOUND else "double"
        casts[c] = F.col(c).cast(fit)
    return df.withColumns(casts)


def split_label(df: DataFrame, label: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Features without the label, and the label by identifier."""
    return df.drop(label), df.select(id_col, label)
