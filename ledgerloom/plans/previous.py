"""Features from earlier applications at the same lender."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import ratio
from ledgerloom.operators.aggregates import (
    DAY_WINDOWS,
    Figure,
    Gathered,
    Lookbacks,
    category_figures,
    columns_of,
    figures,
)
from ledgerloom.operators.bands import by_key, window_figures, with_band
from ledgerloom.operators.cleaning import null_maximum, zero_to_null
from ledgerloom.operators.columns import columns_of_type
from ledgerloom.operators.encoding import fit_categories

CLIENT = "sk_id_curr"
LOOKBACKS = Lookbacks("days_decision", DAY_WINDOWS)

# --- fixed values ---------------------------------------------------------------

MARKED_DAYS = [
    "days_first_drawing",
    "days_first_due",
    "days_last_due_1st_version",
    "days_last_due",
    "days_termination",
]
AGGREGATES = {
    "amt_annuity": ["max", "mean"],
    "amt_application": ["max", "mean"],
    "amt_credit": ["max", "mean"],
    "amt_down_payment": ["max", "mean"],
    "amt_goods_price": ["mean", "sum"],
    "hour_appr_process_start": ["max", "mean"],
    "rate_down_payment": ["max", "mean"],
    "rate_interest_primary": ["max", "mean"],
    "rate_interest_privileged": ["max", "mean"],
    "days_decision": ["max", "mean"],
    "cnt_payment": ["mean", "sum"],
    "days_first_drawing": ["max", "mean"],
    "days_termination": ["max", "mean"],
    "application_credit_ratio": ["max", "mean"],
    "down_payment_to_credit": ["max", "mean"],
    "days_last_due_diff": ["max", "mean"],
}
STATUS = "name_contract_status"
SCOPES = {"cs_app_": "Approved", "cs_ref_": "Refused"}


def clean_previous(previous: DataFrame) -> DataFrame:
    """Unknown day offsets: 0 and the column's maximum become NULL.

    The first drawing keeps its zeros.
    """
    return null_maximum(zero_to_null(previous, MARKED_DAYS[1:]), MARKED_DAYS)


def row_features(previous: DataFrame) -> DataFrame:
    """Differences, ratios and the simple interest of one application."""
    paid = F.col("amt_annuity") * F.col("cnt_payment")
    return previous.withColumns(
        {
            "application_credit_diff": F.col("amt_application") - F.col("amt_credit"),
            "application_credit_ratio": ratio("amt_application", "amt_credit"),
            "credit_to_annuity_ratio": ratio("amt_credit", "amt_annuity"),
            "down_payment_to_credit": ratio("amt_down_payment", "amt_credit"),
            "simple_interests": ratio(ratio(paid, "amt_credit") - 1, "cnt_payment"),
            "days_last_due_diff": F.col("days_last_due_1st_version") - F.col("days_last_due"),
        }
    )


def client_figures(categories: Mapping[str, Sequence[str]]) -> list[Figure]:
    """The ``prev_`` figures over all applications."""
    return figures(AGGREGATES, "prev_") + category_figures(categories, "prev_")


def client_measures(categories: Mapping[str, Sequence[str]]) -> list[Column]:
    return columns_of(client_figures(categories))


def scoped_figures() -> list[Figure]:
    """The ``cs_app_`` and ``cs_ref_`` figures over approved and refused ones."""
    return [f for p, s in SCOPES.items() for f in figures(AGGREGATES, p, f"{STATUS} = '{s}'")]


def scoped_measures() -> list[Column]:
    return columns_of(scoped_figures())


def fit_previous(previous: DataFrame) -> dict[str, list[str]]:
    return fit_categories(previous, columns_of_type(previous, T.StringType))


def per_client(
    previous: DataFrame, categories: Mapping[str, Sequence[str]], keys: Sequence[str] = (CLIENT,)
) -> DataFrame:
    """One row per key; the three scopes are conditional aggregates of one pass."""
    return row_features(previous).groupBy(*keys).agg(
        *client_measures(categories), *scoped_measures()
    )


def gather_previous(
    previous: DataFrame,
    categories: Mapping[str, Sequence[str]],
    lookbacks: Lookbacks = LOOKBACKS,
    tasks: int = 1,
) -> Gathered:
    """The figures of every look-back window, nested, in ``tasks`` tasks at least."""
    wanted = client_figures(categories) + scoped_figures()

    def build(rows: DataFrame) -> DataFrame:
        return lookbacks.gather(window_figures(row_features(rows), [CLIENT], wanted), CLIENT).table

    table = by_key(with_band(previous, lookbacks), CLIENT, build, tasks=tasks)
    return lookbacks.gathered(table, CLIENT, [f.name for f in wanted])


def previous_features(
    previous: DataFrame,
    categories: Mapping[str, Sequence[str]],
    lookbacks: Lookbacks = LOOKBACKS,
) -> DataFrame:
    """One row per client with the figures of every look-back window."""
    return gather_previous(previous, categories, lookbacks).unfold()
