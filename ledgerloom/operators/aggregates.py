"""Aggregates described by data: {column: [functions]}, scopes and look-backs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ratio
from ledgerloom.operators.columns import distinct_names, safe_name

LOOKBACK = "lookback"


def sql_text(value) -> str:
    """A value as a SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _if_any(scope: str | None, value: str) -> str:
    """NULL for groups without a row in scope, as if they had been filtered away."""
    return value if scope is None else f"CASE WHEN count_if({scope}) > 0 THEN {value} END"


def _sum(value: str, scope: str | None) -> str:
    """A sum over no known value is 0, not NULL."""
    return _if_any(scope, f"coalesce(sum({value}), 0)")


def _size(value: str, scope: str | None) -> str:
    return _if_any(scope, "count(1)" if scope is None else f"count_if({scope})")


# SQL text rather than Column calls: a wide table has thousands of these, and
# each call on a Column is a round trip to the JVM.
FUNCTIONS = {
    "min": lambda v, s: f"min({v})",
    "max": lambda v, s: f"max({v})",
    "mean": lambda v, s: f"avg({v})",
    "sum": _sum,
    "var": lambda v, s: f"var_samp({v})",
    "size": _size,
    "count": lambda v, s: _if_any(s, f"count({v})"),
    "nunique": lambda v, s: _if_any(s, f"count(DISTINCT {v})"),
}


def aggregate_name(prefix: str, column: str, function: str) -> str:
    return f"{prefix}{column}_{function}"


@dataclass(frozen=True)
class Figure:
    """A named aggregate: a function, the SQL of its value, and the SQL of the rows it is limited to."""

    name: str
    function: str
    value: str
    scope: str | None = None

    def column(self) -> Column:
        return F.expr(f"{FUNCTIONS[self.function](self.value, self.scope)} AS `{self.name}`")


def figures(
    spec: Mapping[str, Iterable[str]], prefix: str = "", scope: str | None = None
) -> list[Figure]:
    """Figures for a spec; ``scope``, a SQL condition, limits them to some rows."""
    out = []
    for c, functions in spec.items():
        value = f"`{c}`" if scope is None else f"CASE WHEN {scope} THEN `{c}` END"
        out += [Figure(aggregate_name(prefix, c, f), f, value, scope) for f in functions]
    return out


def measures(
    spec: Mapping[str, Iterable[str]], prefix: str = "", scope: str | None = None
) -> list[Column]:
    """The same as aggregate columns."""
    return columns_of(figures(spec, prefix, scope))


def columns_of(figures: Iterable[Figure]) -> list[Column]:
    return [f.column() for f in figures]


def category_flags(categories: Mapping[str, Sequence], null_flag: bool = True) -> dict[str, str]:
    """SQL of a 0/1 flag per category value, by flag name."""
    out = {}
    for c, values in categories.items():
        for v in values:
            out[f"{c}_{safe_name(v)}"] = f"CASE WHEN `{c}` = {sql_text(v)} THEN 1 ELSE 0 END"
        if null_flag:
            out[f"{c}_nan"] = f"CASE WHEN `{c}` IS NULL THEN 1 ELSE 0 END"
    return dict(zip(distinct_names(list(out)), out.values()))


def flag_figures(
    flags: Mapping[str, str], functions: Iterable[str], prefix: str = ""
) -> list[Figure]:
    """Figures of flags, without flag columns in between."""
    return [
        Figure(aggregate_name(prefix, name, f), f, flag)
        for name, flag in flags.items()
        for f in functions
    ]


def flag_measures(
    flags: Mapping[str, str], functions: Iterable[str], prefix: str = ""
) -> list[Column]:
    return columns_of(flag_figures(flags, functions, prefix))


def category_figures(categories: Mapping[str, Sequence], prefix: str = "") -> list[Figure]:
    """Share of each category value, and of NULL, per group."""
    return flag_figures(category_flags(categories), ["mean"], prefix)


def category_shares(categories: Mapping[str, Sequence], prefix: str = "") -> list[Column]:
    return columns_of(category_figures(categories, prefix))


def conditional_share(condition: Column) -> Column:
    """Share of rows that meet a condition (unknown counts as not meeting it)."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


# --- ordered first and last ------------------------------------------------


def ordered_pair(value: str, order: str) -> Column:
    """(order, value) of a known value; its minimum is the first, its maximum the last."""
    pair = F.struct(F.col(order).alias("order"), F.col(value).alias("value"))
    return F.when(F.col(value).isNotNull(), pair)


def first_known(value: str, order: str) -> Column:
    """First non-null value in the order of another column, in its own type.

    A minimum over (order, value), which merges before the shuffle; on a tie the
    smallest value wins.
    """
    return F.min(ordered_pair(value, order)).getField("value")


def last_known(value: str, order: str) -> Column:
    """Last non-null value; on a tie the largest one wins."""
    return F.max(ordered_pair(value, order)).getField("value")


# --- look-back windows -------------------------------------------------------


@dataclass(frozen=True)
class Lookbacks:
    """Nested windows before the application, widest first.

    ``windows`` holds (column suffix, reach); reach None means all rows.
    """

    offset: str
    windows: tuple[tuple[str, int | None], ...]

    def __post_init__(self) -> None:
        reaches = [float("inf") if reach is None else reach for _, reach in self.windows]
        if any(a <= b for a, b in zip(reaches, reaches[1:])):
            raise ValueError("windows must be nested, widest first")

    @property
    def suffixes(self) -> list[str]:
        return [suffix for suffix, _ in self.windows]

    def number_of_windows(self) -> Column:
        """How many windows a row lies in: they are nested, so this is a count of comparisons."""
        inside = [
            F.lit(1) if reach is None else F.when(F.col(self.offset) >= -reach, 1).otherwise(0)
            for _, reach in self.windows
        ]
        return sum(inside[1:], inside[0])

    def expand(self, df: DataFrame) -> DataFrame:
        """One copy of a row per window it lies in, numbered in ``lookback``.

        For aggregates that do not merge; the others are made of bands.
        """
        n = self.number_of_windows()
        numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1))
        return df.withColumn(LOOKBACK, F.explode(numbers))

    def gather(self, long: DataFrame, key: str) -> "Gathered":
        """From one row per key and window to one row per key, still nested.

        A key has at most one row per window; they are kept in a map.
        """
        names = tuple(c for c in long.columns if c not in (key, LOOKBACK))
        figures = ", ".join(f"`{c}`" for c in names)
        rows = F.expr(f"map_from_entries(collect_list(struct({LOOKBACK}, struct({figures})))) AS _rows")
        return Gathered(long.groupBy(key).agg(rows), key, names, tuple(self.suffixes))

    def gathered(self, table: DataFrame, key: str, names: Sequence[str]) -> "Gathered":
        """A table that is nested already."""
        return Gathered(table, key, tuple(names), tuple(self.suffixes))

    def widen(self, long: DataFrame, key: str) -> DataFrame:
        """The same, unfolded into one column per figure and window."""
        return self.gather(long, key).unfold()


@dataclass(frozen=True)
class Gathered:
    """Figures by window in the map column ``_rows``, one row per key.

    Nested, a table of a thousand figures is one column: joins and sorts move it
    as a whole, and only the last projection of a plan is wide.
    """

    table: DataFrame
    key: str
    names: tuple[str, ...]
    suffixes: tuple[str, ...]

    def unfold(self) -> DataFrame:
        return unfold(self.table, [self.key], [self])


def unfold(df: DataFrame, keep: Sequence[str], parts: Sequence[Gathered]) -> DataFrame:
    """Columns ``keep`` and the figures of gathered tables joined to ``df``.

    With several parts their map columns are ``_rows_0``, ``_rows_1`` and so on.
    """
    maps = ["_rows"] if len(parts) == 1 and "_rows" in df.columns else [
        f"_rows_{i}" for i in range(len(parts))
    ]
    picked, names = [], list(keep)
    for column, part in zip(maps, parts):
        for i, suffix in enumerate(part.suffixes):
            picked.append(F.element_at(column, F.lit(i)).alias(f"{column}_{i}"))
            names += [c + suffix for c in part.names]
    nested = df.select(*keep, *picked)
    wide = nested.select(*keep, *[f"{c}.*" for c in nested.columns[len(keep):]])
    return wide.toDF(*names)


# The look-back windows and their column suffixes.
DAY_WINDOWS = (
    ("", None),
    ("_year", 365),
    ("_half_year", 182),
    ("_quarter", 90),
    ("_month", 30),
    ("_fortnight", 14),
    ("_week", 7),
)
MONTH_WINDOWS = (
    ("", None),
    ("_year", 12),
    ("_half_year", 6),
    ("_quarter", 3),
    ("_month", 1),
)
