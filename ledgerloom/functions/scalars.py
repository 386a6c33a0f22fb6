"""Column expressions shared by all plans.

All of them are built-in JVM expressions, so they stay inside code generation.
Division and casts never raise: a zero divisor or unreadable text gives NULL,
also with ANSI mode on.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col",
    "ratio",
    "settled",
    "total",
    "date_key",
    "month_label",
    "month_of_key",
    "first_of_month",
    "shift_days",
    "shift_months",
    "years",
    "whole_years_ago",
    "at_least_zero",
    "reaches",
    "is_positive",
    "matches",
    "yes_no",
    "decode",
]


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom`` as double, NULL for a zero or NULL divisor."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def settled(value: Column, digits: int) -> Column:
    """Round half up; ties are not decided by the order in which doubles were added."""
    return F.round(F.round(value, digits + 5), digits)


def total(*values: Column | str) -> Column:
    """Row-wise sum that is NULL as soon as one input is NULL."""
    return reduce(add, [as_col(v) for v in values])


def date_key(day: Column | str) -> Column:
    """Date as the integer yyyymmdd, by arithmetic instead of text formatting."""
    day = as_col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_label(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyy-MM")


def month_of_key(key: Column | str) -> Column:
    """The yyyymm part of an integer date key, as text."""
    return F.substring(as_col(key).cast("string"), 1, 6)


def first_of_month(year: Column | str, month: Column | str) -> Column:
    return F.make_date(as_col(year), as_col(month), F.lit(1))


def shift_days(day: Column | str, offset: Column | str) -> Column:
    return F.date_add(as_col(day), as_col(offset).try_cast("int"))


def shift_months(day: Column | str, offset: Column | str) -> Column:
    """Month shift; a day past the end of the target month becomes its last day."""
    return F.add_months(as_col(day), as_col(offset).try_cast("int"))


def years(days: Column | str) -> Column:
    return as_col(days) / F.lit(365.0)


def whole_years_ago(days: Column | str) -> Column:
    """Completed years for a negative day offset."""
    return F.floor(-as_col(days) / F.lit(365)).cast("int")


def at_least_zero(value: Column | str) -> Column:
    """Negative values become 0; NULL stays NULL (``greatest`` would lose it)."""
    value = as_col(value)
    return F.when(value <= 0, F.lit(0).cast("int")).otherwise(value)


def reaches(value: Column | str, bound: float) -> Column:
    """1 if the value is at least ``bound``, 0 otherwise and for NULL."""
    return F.when(as_col(value) >= bound, 1).otherwise(0)


def is_positive(value: Column | str, bound: float = 0) -> Column:
    """1 if the value is above ``bound``, 0 otherwise and for NULL."""
    return F.when(as_col(value) > bound, 1).otherwise(0)


def matches(value: Column | str, wanted) -> Column:
    """1 if equal to ``wanted``, 0 otherwise and for NULL."""
    return F.when(as_col(value) == F.lit(wanted), 1).otherwise(0)


def yes_no(value: Column | str) -> Column:
    """Text flag to integer: digits are read as they are, Y is 1, N is 0."""
    value = as_col(value)
    return (
        F.when(value == "Y", 1).when(value == "N", 0).otherwise(value.try_cast("int"))
    )


def decode(value: Column | str, labels: dict, default=None) -> Column:
    """Look a value up in a small fixed table."""
    value = as_col(value)
    first, *rest = labels.items()
    out = F.when(value == F.lit(first[0]), F.lit(first[1]))
    for code, label in rest:
        out = out.when(value == F.lit(code), F.lit(label))
    return out.otherwise(F.lit(default))
