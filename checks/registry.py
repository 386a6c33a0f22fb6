"""Queries and their check SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.roles import role, shipped, table, with_roles
from ledgerloom.plans import star

STAR_ROLES = {
    "application_train": "application",
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
    "previous_application": "previous",
    "pos_cash_balance": "pos",
    "credit_card_balance": "card",
    "installments_payments": "instalments",
}


@dataclass(frozen=True)
class Data:
    """Tables, roles and star tables of one folder, by name."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def role(self, name: str) -> DataFrame:
        return role(self.spark, self.folder, name)

    def roles(self, *names: str) -> list[DataFrame]:
        """Several roles; line items meet their orders once for all of them."""
        lines = shipped(self.spark, self.folder)
        return [role(self.spark, self.folder, name, lines) for name in names]

    def star(self, *names: str) -> list[DataFrame]:
        out = []
        for name in names:
            source, build = star.TABLES[name]
            out.append(build(self.role(STAR_ROLES[source])))
        return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def query(name: str, sql: str | None = None, round_: Sequence[str] = (), digits: int = 9):
    """Register a query.

    Columns in ``round_`` hold sums of fractions, whose last bits depend on the
    order of addition; both sides round them.  Large variances get fewer digits.
    """

    def places_of(name: str) -> int:
        if "_var" not in name:
            return digits
        if name.startswith("cents"):
            return 2
        if "_days_" in name:
            return 4
        if "_amt_" in name:
            return 5
        return 11 if any(r in name for r in ("limit_use", "_div_min", "limit_ratio")) else 6

    places = {c: places_of(c) for c in round_}

    def register(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(Data(spark, folder))
            return rounded(df, places) if places else df

        QUERIES[name] = run
        if sql is not None:
            text = with_roles(sql)
            if places:
                swaps = ", ".join(f"round({c}, {n}) AS {c}" for c, n in places.items())
                text = f"SELECT * REPLACE ({swaps}) FROM ({text})"
            SQL[name] = text
        return build

    return register
