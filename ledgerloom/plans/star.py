"""Star schema: seven dimensions and seven facts from the typed raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import (
    date_key,
    decode,
    matches,
    ratio,
    shift_days,
    shift_months,
    total,
    whole_years_ago,
    yes_no,
)
from ledgerloom.operators.columns import project
from ledgerloom.session import at_once
from ledgerloom.sources import Lake

# --- fixed values: columns of the sources and of the star tables, day offsets behind dates, labels ---

DOCUMENT_FLAGS = [f"flag_document_{i}" for i in range(2, 22)]
REQUEST_COUNTS = [
    f"amt_req_credit_bureau_{period}" for period in ("hour", "day", "week", "mon", "qrt", "year")
]
EXT_SOURCES = ["ext_source_1", "ext_source_2", "ext_source_3"]

STATUS_LABELS = {
    "C": "closed",
    "X": "unknown",
    "0": "no_DPD",
    "1": "DPD_1_30",
    "2": "DPD_31_60",
    "3": "DPD_61_90",
    "4": "DPD_91_120",
    "5": "DPD_120_plus",
}

BUREAU_COLUMNS = [
    "sk_id_curr", "sk_id_bureau", "credit_active", "credit_currency", "credit_date",
    "credit_day_overdue", "enddate_date", "close_date", "amt_credit_max_overdue",
    "cnt_credit_prolong", "amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_limit",
    "amt_credit_sum_overdue", "credit_type", "update_date", "amt_annuity",
]
BUREAU_DATES = {
    "credit_date": "days_credit",
    "enddate_date": "days_credit_enddate",
    "close_date": "days_enddate_fact",
    "update_date": "days_credit_update",
}

PREVIOUS_COLUMNS = [
    "sk_id_curr", "sk_id_prev", "application_date_id", "name_contract_type", "amt_annuity",
    "amt_application", "amt_credit", "amt_down_payment", "amt_goods_price",
    "weekday_appr_process_start", "hour_appr_process_start", "flag_last_appl_per_contract",
    "nflag_last_appl_in_day", "rate_down_payment", "rate_interest_primary",
    "rate_interest_privileged", "name_cash_loan_purpose", "name_contract_status",
    "decision_date", "name_payment_type", "code_reject_reason", "name_type_suite",
    "name_client_type", "name_goods_category", "name_portfolio", "name_product_type",
    "channel_type", "sellerplace_area", "name_seller_industry", "cnt_payment",
    "name_yield_group", "product_combination", "first_drawing_date", "first_due_date",
    "last_due_1st_date", "last_due_date", "termination_date", "nflag_insured_on_approval",
]
PREVIOUS_DATES = {
    "decision_date": "days_decision",
    "first_drawing_date": "days_first_drawing",
    "first_due_date": "days_first_due",
    "last_due_1st_date": "days_last_due_1st_version",
    "last_due_date": "days_last_due",
    "termination_date": "days_termination",
}

CARD_AMOUNTS = [
    "amt_balance", "amt_credit_limit_actual", "amt_drawings_atm_current",
    "amt_drawings_current", "amt_drawings_other_current", "amt_drawings_pos_current",
    "amt_inst_min_regularity", "amt_payment_current", "amt_payment_total_current",
    "amt_receivable_principal", "amt_recivable", "amt_total_receivable",
]
CARD_COUNTS = [
    "cnt_drawings_atm_current", "cnt_drawings_current", "cnt_drawings_other_current",
    "cnt_drawings_pos_current", "cnt_instalment_mature_cum",
]

# --- dimensions ---------------------------------------------------------------


def _same(names: list[str]) -> dict[str, str]:
    return {n: n for n in names}


def _dated(application: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct rows under the key (client, application date)."""
    key = date_key("ingest_date").alias("application_date_id")
    return application.select("sk_id_curr", key, *columns).distinct()


def dim_date(application: DataFrame) -> DataFrame:
    day = F.col("application_date")
    dates = application.select(F.col("ingest_date").alias("application_date")).distinct()
    return dates.select(
        day,
        date_key(day).alias("date_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("weekday"),
    )


def dim_client(application: DataFrame, map_yes_no: bool = True) -> DataFrame:
    """Who the client is.  Car and realty flags given as Y/N become 1/0 unless
    ``map_yes_no`` is off; then only numeric text survives the cast."""
    flag = yes_no if map_yes_no else (lambda c: F.col(c).try_cast("int"))
    return application.select(
        "sk_id_curr",
        "code_gender",
        F.col("cnt_children").try_cast("int").alias("cnt_children"),
        flag("flag_own_car").alias("flag_own_car"),
        flag("flag_own_realty").alias("flag_own_realty"),
        "name_income_type",
        "name_education_type",
        "name_family_status",
        F.col("cnt_fam_members").try_cast("int").alias("cnt_fam_members"),
        "name_housing_type",
        F.col("region_population_relative").try_cast("double").alias("region_population_relative"),
        F.col("region_rating_client").try_cast("int").alias("region_rating_client"),
        F.col("region_rating_client_w_city").try_cast("int").alias("region_rating_client_w_city"),
    ).distinct()


def dim_contract(application: DataFrame) -> DataFrame:
    return _dated(
        application,
        "name_contract_type",
        "name_type_suite",
        "amt_credit",
        "amt_annuity",
        "amt_goods_price",
        F.round(ratio("amt_credit", "amt_income_total"), 4).alias("credit_income_ratio"),
        F.round(ratio("amt_annuity", "amt_credit"), 4).alias("annuity_credit_ratio"),
    )


def dim_employment(application: DataFrame) -> DataFrame:
    years = whole_years_ago("days_employed").alias("employment_years")
    return _dated(application, years, "occupation_type", "organization_type")


def dim_ext_source(application: DataFrame) -> DataFrame:
    scores = [F.col(c).try_cast("double").alias(c) for c in EXT_SOURCES]
    mean = ratio(total(*EXT_SOURCES), F.lit(len(EXT_SOURCES)))
    return _dated(
        application,
        *scores,
        mean.alias("ext_source_mean"),
        F.greatest(*EXT_SOURCES).alias("ext_source_max"),
    )


def dim_document_flags(application: DataFrame) -> DataFrame:
    flags = [F.col(c).try_cast("int").alias(c) for c in DOCUMENT_FLAGS]
    return _dated(
        application, *flags, total(*DOCUMENT_FLAGS).try_cast("int").alias("num_docs_provided")
    )


def dim_cb_requests(application: DataFrame) -> DataFrame:
    return _dated(application, *[F.col(c).try_cast("int").alias(c) for c in REQUEST_COUNTS])


# --- facts ----------------------------------------------------------------------


def fact_application(application: DataFrame) -> DataFrame:
    return application.select(
        "sk_id_curr", date_key("ingest_date").alias("application_date_id"), "target"
    )


def _dates(offsets: dict[str, str]) -> dict[str, Column]:
    return {name: shift_days("ingest_date", offset) for name, offset in offsets.items()}


def fact_bureau(bureau: DataFrame) -> DataFrame:
    """Loans at other lenders, day offsets turned into dates."""
    return bureau.withColumns(_dates(BUREAU_DATES)).select(*BUREAU_COLUMNS)


def fact_bureau_balance(bureau_balance: DataFrame) -> DataFrame:
    return bureau_balance.select(
        "sk_id_bureau",
        shift_months("ingest_date", "months_balance").alias("balance_date"),
        F.col("status").alias("status_code"),
        decode("status", STATUS_LABELS, "other").alias("status_desc"),
    )


def fact_previous_application(previous: DataFrame) -> DataFrame:
    typed = {c: "double" for c in PREVIOUS_COLUMNS if c.startswith(("amt_", "rate_"))}
    typed |= {"hour_appr_process_start": "int", "cnt_payment": "int"}
    derived = _dates(PREVIOUS_DATES) | {
        "application_date_id": date_key("ingest_date"),
        "flag_last_appl_per_contract": matches("flag_last_appl_per_contract", "Y"),
        "nflag_last_appl_in_day": matches("nflag_last_appl_in_day", 1),
        "nflag_insured_on_approval": matches("nflag_insured_on_approval", 1),
    }
    return project(previous.withColumns(derived), _same(PREVIOUS_COLUMNS), typed)


def fact_pos_cash_balance(pos: DataFrame) -> DataFrame:
    counts = ["months_balance", "cnt_instalment", "cnt_instalment_future", "sk_dpd", "sk_dpd_def"]
    names = ["sk_id_curr", "sk_id_prev", *counts[:3], "name_contract_status", *counts[3:]]
    return project(pos, _same(names), {c: "int" for c in counts})


def fact_credit_card_balance(card: DataFrame) -> DataFrame:
    whole = ["months_balance", *CARD_COUNTS, "sk_dpd", "sk_dpd_def"]
    types = {c: "double" for c in CARD_AMOUNTS} | {c: "int" for c in whole}
    names = ["sk_id_curr", "sk_id_prev", "months_balance", *CARD_AMOUNTS, *CARD_COUNTS]
    return project(card, _same([*names, "name_contract_status", "sk_dpd", "sk_dpd_def"]), types)


def fact_installments_payments(instalments: DataFrame) -> DataFrame:
    whole = ["num_instalment_version", "num_instalment_number", "days_instalment", "days_entry_payment"]
    money = ["amt_instalment", "amt_payment"]
    types = {c: "int" for c in whole} | {c: "double" for c in money}
    return project(instalments, _same(["sk_id_curr", "sk_id_prev", *whole, *money]), types)


# --- the layer -------------------------------------------------------------------

TABLES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "dim_date": ("application_train", dim_date),
    "dim_client": ("application_train", dim_client),
    "dim_contract": ("application_train", dim_contract),
    "dim_employment": ("application_train", dim_employment),
    "dim_ext_source": ("application_train", dim_ext_source),
    "dim_document_flags": ("application_train", dim_document_flags),
    "dim_cb_requests": ("application_train", dim_cb_requests),
    "fact_application": ("application_train", fact_application),
    "fact_bureau": ("bureau", fact_bureau),
    "fact_bureau_balance": ("bureau_balance", fact_bureau_balance),
    "fact_previous_application": ("previous_application", fact_previous_application),
    "fact_pos_cash_balance": ("pos_cash_balance", fact_pos_cash_balance),
    "fact_credit_card_balance": ("credit_card_balance", fact_credit_card_balance),
    "fact_installments_payments": ("installments_payments", fact_installments_payments),
}


def build_star(bronze: Lake, silver: Lake, as_of=None) -> None:
    """Write all dimensions and facts, some at a time."""
    at_once(silver.spark, [
        lambda name=name, source=source, build=build: silver.replace(build(bronze.read(source, as_of)), name)
        for name, (source, build) in TABLES.items()
    ])
