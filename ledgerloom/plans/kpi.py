"""Portfolio, origination, delinquency and bureau figures.

Facts are aggregated to their join key before they meet a dimension, so a
client or loan with very many rows enters each join as one row, and the joins
move counts and sums instead of details.  Dimensions may repeat a key; a
pre-aggregated fact then counts once per repetition, as a row join would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import first_of_month, month_label, month_of_key, ratio, settled
from ledgerloom.operators.joins import outer_total
from ledgerloom.plans.star import REQUEST_COUNTS
from ledgerloom.session import at_once
from ledgerloom.sources import Lake

CLIENT = "sk_id_curr"
DATED = ["sk_id_curr", "application_date_id"]
LOAN = ["sk_id_curr", "sk_id_prev"]


def _n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def _per(df: DataFrame, keys, *aggregates: Column) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*aggregates)


# --- origination --------------------------------------------------------------


def contract_summary(dim_contract: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Contracts per month and type.

    Contracts are summed per date first; the calendar is joined to that.
    """
    term = ratio("amt_credit", "amt_annuity")
    per_day = _per(
        dim_contract,
        ["application_date_id", "name_contract_type"],
        F.count(CLIENT).alias("n"),
        F.sum("amt_credit").alias("credit"),
        F.sum("credit_income_ratio").alias("ratio_sum"),
        F.count("credit_income_ratio").alias("ratio_n"),
        F.sum(term).alias("term_sum"),
        F.count(term).alias("term_n"),
    )
    calendar = dim_date.select(F.col("date_id").alias("application_date_id"), "year", "month")
    return (
        per_day.join(calendar, "application_date_id", "left")
        .groupBy("year", "month", "name_contract_type")
        .agg(
            F.sum("n").alias("cnt_contracts"),
            settled(F.sum("credit"), 2).alias("sum_credit"),
            settled(ratio(F.sum("ratio_sum"), F.sum("ratio_n")), 4).alias("avg_credit_income_ratio"),
            settled(ratio(F.sum("term_sum"), F.sum("term_n")), 2).alias("avg_term_months"),
        )
        .select(
            month_label(first_of_month("year", "month")).alias("month_year"),
            "name_contract_type",
            "cnt_contracts",
            "sum_credit",
            "avg_credit_income_ratio",
            "avg_term_months",
        )
    )


def origination_count(
    fact_application: DataFrame, dim_date: DataFrame, dim_contract: DataFrame
) -> DataFrame:
    """Applications per month and contract type."""
    contracts = _per(dim_contract, [*DATED, "name_contract_type"], _n("copies"))
    per_day = (
        _per(fact_application, DATED, _n())
        .join(contracts, DATED)
        .groupBy("application_date_id", F.col("name_contract_type").alias("contract_type"))
        .agg(F.sum(F.col("n") * F.col("copies")).alias("n"))
    )
    calendar = dim_date.select(F.col("date_id").alias("application_date_id"), "application_date")
    return (
        per_day.join(calendar, "application_date_id")
        .groupBy(F.trunc("application_date", "month").alias("month"), "contract_type")
        .agg(F.sum("n").alias("num_applications"))
        .select(month_label("month").alias("month_year"), "contract_type", "num_applications")
    )


def _credit_per_date(fact_application: DataFrame, dim_contract: DataFrame) -> DataFrame:
    """Per client and date: credit summed over all pairs of application and contract."""
    credit = _per(
        dim_contract, DATED, F.sum("amt_credit").alias("credit"), F.count("amt_credit").alias("known")
    )
    return (
        _per(fact_application, DATED, _n())
        .join(credit, DATED)
        .select(
            *DATED,
            (F.col("credit") * F.col("n")).alias("credit"),
            (F.col("known") * F.col("n")).alias("known"),
        )
    )


def origination_sum(
    fact_application: DataFrame,
    dim_contract: DataFrame,
    dim_client: DataFrame,
    dim_employment: DataFrame,
) -> DataFrame:
    """Credit paid out per region and occupation."""
    jobs = _per(dim_employment, [*DATED, "occupation_type"], _n("copies"))
    per_client = (
        _credit_per_date(fact_application, dim_contract)
        .join(jobs, DATED)
        .groupBy(CLIENT, "occupation_type")
        .agg(F.sum(F.col("credit") * F.col("copies")).alias("credit"))
    )
    return (
        per_client.join(dim_client.select(CLIENT, "region_population_relative"), CLIENT)
        .groupBy(
            F.col("region_population_relative").alias("region"),
            F.col("occupation_type").alias("occupation"),
        )
        .agg(F.sum("credit").alias("total_disbursed"))
    )


def origination_avg(
    fact_application: DataFrame, dim_contract: DataFrame, dim_client: DataFrame
) -> DataFrame:
    """Mean credit per income type."""
    per_client = _per(
        _credit_per_date(fact_application, dim_contract),
        CLIENT,
        F.sum("credit").alias("credit"),
        F.sum("known").alias("known"),
    )
    return (
        per_client.join(dim_client.select(CLIENT, "name_income_type"), CLIENT)
        .groupBy(F.col("name_income_type").alias("income_type"))
        .agg(ratio(F.sum("credit"), F.sum("known")).alias("avg_loan_amount"))
    )


def origination_approval_rate(
    fact_application: DataFrame,
    dim_ext_source: DataFrame,
    dim_cb_requests: DataFrame,
    score_digits: int | None = None,
) -> DataFrame:
    """Share of good loans per external score and bureau requests in the year.

    The score is a floating-point key; ``score_digits`` rounds it.
    """
    year = REQUEST_COUNTS[-1]
    facts = _per(fact_application, DATED, _n(), F.count_if(F.col("target") == 0).alias("good"))
    scores = _per(dim_ext_source, [*DATED, "ext_source_mean"], _n("scores"))
    requests = _per(dim_cb_requests, [*DATED, year], _n("requests"))
    score = F.col("ext_source_mean")
    if score_digits is not None:
        score = F.round(score, score_digits)
    copies = F.col("scores") * F.col("requests")
    return (
        facts.join(scores, DATED)
        .join(requests, DATED)
        .groupBy(score.alias("ext_source_mean"), F.col(year).alias("cb_requests_year"))
        .agg(
            ratio(F.sum(F.col("good") * copies), F.sum(F.col("n") * copies)).alias("approval_rate")
        )
    )


# --- portfolio ------------------------------------------------------------------


def total_active_balance(card: DataFrame, pos: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Card balance plus open instalments per region."""
    cards = _per(card, CLIENT, F.sum("amt_balance").alias("cc_balance"))
    loans = _per(pos, CLIENT, F.sum("cnt_instalment").alias("pos_balance"))
    both = outer_total(cards, loans, CLIENT, ["cc_balance", "pos_balance"])
    return (
        both.join(dim_client.select(CLIENT, "region_population_relative"), CLIENT)
        .groupBy(F.col("region_population_relative").alias("region"))
        .agg(F.sum(F.col("cc_balance") + F.col("pos_balance")).alias("total_active_balance"))
    )


def utilization_ratio(card: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Balance over limit per income type."""
    per_client = _per(
        card,
        CLIENT,
        F.sum("amt_balance").alias("balance"),
        F.sum("amt_credit_limit_actual").alias("limit"),
    )
    return (
        per_client.join(dim_client.select(CLIENT, "name_income_type"), CLIENT)
        .groupBy(F.col("name_income_type").alias("client_segment"))
        .agg(ratio(F.sum("balance"), F.sum("limit")).alias("utilization_ratio"))
    )


def overdue_balance(card: DataFrame) -> DataFrame:
    """Overdue balance per month before the application."""
    overdue = card.where(F.col("sk_dpd") > 0)
    return overdue.groupBy(F.col("months_balance").alias("month_offset")).agg(
        F.sum("amt_balance").alias("overdue_balance")
    )


def _bridge(per_loan: DataFrame, previous: DataFrame) -> DataFrame:
    """Give per-loan figures the application date of the loan."""
    dates = _per(previous, [*LOAN, "application_date_id"], _n("copies"))
    return per_loan.join(dates, LOAN)


def overdue_ratio(card: DataFrame, previous: DataFrame, dim_contract: DataFrame) -> DataFrame:
    """Share of overdue card months per contract type of the application."""
    per_loan = _per(card, LOAN, _n(), F.count_if(F.col("sk_dpd") > 0).alias("late"))
    per_date = _per(
        _bridge(per_loan, previous),
        DATED,
        F.sum(F.col("n") * F.col("copies")).alias("n"),
        F.sum(F.col("late") * F.col("copies")).alias("late"),
    )
    contracts = _per(dim_contract, [*DATED, "name_contract_type"], _n("contracts"))
    return (
        per_date.join(contracts, DATED)
        .groupBy(F.col("name_contract_type").alias("contract_type"))
        .agg(
            ratio(
                F.sum(F.col("late") * F.col("contracts")), F.sum(F.col("n") * F.col("contracts"))
            ).alias("overdue_ratio")
        )
    )


# --- delinquency ----------------------------------------------------------------


def default_rate(fact_application: DataFrame, dim_contract: DataFrame) -> DataFrame:
    """Share of bad loans per contract type."""
    facts = _per(fact_application, DATED, _n(), F.count_if(F.col("target") == 1).alias("bad"))
    contracts = _per(dim_contract, [*DATED, "name_contract_type"], _n("copies"))
    return (
        facts.join(contracts, DATED)
        .groupBy(F.col("name_contract_type").alias("contract_type"))
        .agg(
            ratio(
                F.sum(F.col("bad") * F.col("copies")), F.sum(F.col("n") * F.col("copies"))
            ).alias("default_rate")
        )
    )


# Days past due that count as delinquent.
DELINQUENCY_BOUNDS = (30, 60, 90)


def delinquency_rates(
    instalments: DataFrame,
    dim_client: DataFrame,
    bounds=DELINQUENCY_BOUNDS,
    measure: str = "days_instalment",
) -> DataFrame:
    """Per family status, for every bound: overdue instalments over all instalments.

    One pass for all bounds; a bound no instalment of the status exceeds is NULL.
    """
    per_client = _per(
        instalments,
        CLIENT,
        _n(),
        *[F.count_if(F.col(measure) > b).alias(f"over_{b}") for b in bounds],
    )
    shares = [
        F.when(
            F.sum(f"over_{b}") > 0, ratio(F.sum(f"over_{b}"), F.sum("n"))
        ).alias(f"delinq_{b}")
        for b in bounds
    ]
    return (
        per_client.join(dim_client.select(CLIENT, "name_family_status"), CLIENT)
        .where(F.col("name_family_status").isNotNull())
        .groupBy(F.col("name_family_status").alias("family_status"))
        .agg(*shares)
    )


def delinquency_rate(rates: DataFrame, bound: int) -> DataFrame:
    """One bound of ``delinquency_rates``, without the statuses it does not reach."""
    name = f"delinq_{bound}"
    return rates.where(F.col(name).isNotNull()).select("family_status", name)


def avg_days_past_due(
    instalments: DataFrame,
    previous: DataFrame,
    dim_employment: DataFrame,
    measure: str = "days_entry_payment",
) -> DataFrame:
    """Mean positive day offset of payments per occupation."""
    per_loan = _per(
        instalments.where(F.col(measure) > 0), LOAN, _n(), F.sum(measure).alias("days")
    )
    per_date = _per(
        _bridge(per_loan, previous),
        DATED,
        F.sum(F.col("n") * F.col("copies")).alias("n"),
        F.sum(F.col("days") * F.col("copies")).alias("days"),
    )
    jobs = _per(dim_employment, [*DATED, "occupation_type"], _n("jobs"))
    return (
        per_date.join(jobs, DATED)
        .groupBy(F.col("occupation_type").alias("occupation"))
        .agg(
            ratio(F.sum(F.col("days") * F.col("jobs")), F.sum(F.col("n") * F.col("jobs"))).alias(
                "avg_days_past_due"
            )
        )
    )


def time_to_first_default(
    instalments: DataFrame,
    previous: DataFrame,
    dim_ext_source: DataFrame,
    measure: str = "days_instalment",
) -> DataFrame:
    """Smallest positive day offset per external score."""
    first = F.min(measure).alias("first")
    per_loan = _per(instalments.where(F.col(measure) > 0), LOAN, first)
    per_date = _per(_bridge(per_loan, previous), DATED, F.min("first").alias("first"))
    return (
        per_date.join(dim_ext_source.select(*DATED, "ext_source_mean"), DATED)
        .groupBy("ext_source_mean")
        .agg(F.min("first").alias("time_to_first_default"))
    )


# --- bureau -----------------------------------------------------------------------


def old_loans_count(fact_bureau: DataFrame, dim_client: DataFrame) -> DataFrame:
    return (
        _per(fact_bureau, CLIENT, _n())
        .join(dim_client.select(CLIENT, "region_population_relative"), CLIENT)
        .groupBy(F.col("region_population_relative").alias("region"))
        .agg(F.sum("n").alias("old_loans_count"))
    )


def old_credit_by_year(fact_bureau: DataFrame) -> DataFrame:
    return fact_bureau.groupBy(F.year("credit_date").alias("year")).agg(
        F.sum("amt_credit_sum").alias("old_credit_sum")
    )


def prolongations_by_requests(fact_bureau: DataFrame, dim_cb_requests: DataFrame) -> DataFrame:
    """Prolongations per yearly bureau requests.

    The join is on the client alone: a client with several application dates
    counts for each of them.
    """
    year = REQUEST_COUNTS[-1]
    requests = _per(dim_cb_requests, [CLIENT, year], _n("dates"))
    return (
        _per(fact_bureau, CLIENT, F.sum("cnt_credit_prolong").alias("prolonged"))
        .join(requests, CLIENT)
        .groupBy(F.col(year).alias("cb_requests_year"))
        .agg(F.sum(F.col("prolonged") * F.col("dates")).alias("total_credit_prolong"))
    )


def requests_by_month(dim_cb_requests: DataFrame) -> DataFrame:
    """All six request counts per month; NULL if one of them is never known."""
    per_day = _per(
        dim_cb_requests, "application_date_id", *[F.sum(c).alias(c) for c in REQUEST_COUNTS]
    )
    summed = sum((F.sum(c) for c in REQUEST_COUNTS[1:]), F.sum(REQUEST_COUNTS[0]))
    return per_day.groupBy(month_of_key("application_date_id").alias("month_year")).agg(
        summed.alias("total_cb_requests")
    )


# --- the layer ----------------------------------------------------------------------

INPUTS: Mapping[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "contract_summary": (contract_summary, ("dim_contract", "dim_date")),
    "origination_count": (origination_count, ("fact_application", "dim_date", "dim_contract")),
    "origination_sum": (
        origination_sum,
        ("fact_application", "dim_contract", "dim_client", "dim_employment"),
    ),
    "origination_avg": (origination_avg, ("fact_application", "dim_contract", "dim_client")),
    "origination_approval_rate": (
        origination_approval_rate,
        ("fact_application", "dim_ext_source", "dim_cb_requests"),
    ),
    "portfolio_total_active_balance": (
        total_active_balance,
        ("fact_credit_card_balance", "fact_pos_cash_balance", "dim_client"),
    ),
    "portfolio_utilization_ratio": (utilization_ratio, ("fact_credit_card_balance", "dim_client")),
    "portfolio_overdue_balance": (overdue_balance, ("fact_credit_card_balance",)),
    "portfolio_overdue_ratio": (
        overdue_ratio,
        ("fact_credit_card_balance", "fact_previous_application", "dim_contract"),
    ),
    "delinquency_default_default_rate": (default_rate, ("fact_application", "dim_contract")),
    "delinquency_avg_days_past_due": (
        avg_days_past_due,
        ("fact_installments_payments", "fact_previous_application", "dim_employment"),
    ),
    "delinquency_time_to_first_default": (
        time_to_first_default,
        ("fact_installments_payments", "fact_previous_application", "dim_ext_source"),
    ),
    "cb_old_loans_count": (old_loans_count, ("fact_bureau", "dim_client")),
    "cb_old_credit_sum_by_year": (old_credit_by_year, ("fact_bureau",)),
    "cb_credit_prolong_by_requests_year": (
        prolongations_by_requests,
        ("fact_bureau", "dim_cb_requests"),
    ),
    "cb_total_requests_by_month": (requests_by_month, ("dim_cb_requests",)),
}


def build_kpis(silver: Lake, gold: Lake) -> None:
    """Write all figures, some at a time; the three delinquency bounds share one pass."""

    def write(name: str) -> None:
        build, inputs = INPUTS[name]
        df = build(*[silver.read(i) for i in inputs])
        if name == "contract_summary":
            gold.replace(df, name)
        else:
            gold.replace_rows(df, name)

    def write_rates() -> None:
        rates_name = "delinquency_default_rates"
        gold.replace_rows(
            delinquency_rates(
                silver.read("fact_installments_payments"), silver.read("dim_client")
            ),
            rates_name,
        )
        for bound in DELINQUENCY_BOUNDS:
            gold.replace_rows(
                delinquency_rate(gold.read(rates_name), bound), f"delinquency_default_rate_{bound}"
            )

    at_once(gold.spark, [*[partial(write, name) for name in INPUTS], write_rates])
