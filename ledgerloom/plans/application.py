"""Cleaning and features of application tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import ratio
from ledgerloom.operators.cleaning import (
    fill_most_frequent,
    fill_nulls,
    null_maximum_everywhere,
    null_where,
    replace_values,
)
from ledgerloom.operators.encoding import LIMIT, Limits, category_pairs, category_rows, one_hot
from ledgerloom.operators.columns import columns_of_type
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.plans.learned import learned_categories, learned_rows, read_categories
from ledgerloom.plans.star import DOCUMENT_FLAGS
from ledgerloom.sources import Lake, export_csv, written

# --- fixed values: repairs ------------------------------------------------------

TEXT_DEFAULTS = {
    "name_family_status": "Data_Not_Available",
    "name_housing_type": "Data_Not_Available",
    "flag_mobil": "Data_Not_Available",
    "flag_emp_phone": "Data_Not_Available",
    "flag_cont_mobile": "Data_Not_Available",
    "flag_email": "Data_Not_Available",
    "occupation_type": "Data_Not_Available",
    "name_type_suite": "Unaccompanied",
}
REPLACEMENTS = {"name_family_status": {"Unknown": "Married"}, "code_gender": {"XNA": "M"}}
NUMBER_DEFAULTS = {
    "amt_annuity": 0.0,
    "amt_goods_price": 0.0,
    "ext_source_1": 0.0,
    "ext_source_2": 0.0,
    "ext_source_3": 0.0,
}

# --- fixed values: features -----------------------------------------------------

QUOTIENTS = {
    "credit_income_percent": ("amt_credit", "amt_income_total"),
    "annuity_income_percent": ("amt_annuity", "amt_income_total"),
    "credit_annuity_percent": ("amt_credit", "amt_annuity"),
    "family_cnt_income_percent": ("amt_income_total", "cnt_fam_members"),
    "credit_term": ("amt_annuity", "amt_credit"),
    "birth_employed_percent": ("days_employed", "days_birth"),
    "children_cnt_income_percent": ("amt_income_total", "cnt_children"),
}
DIFFERENCES = {
    "credit_goods_diff": ("amt_credit", "amt_goods_price"),
    "id_registration_diff": ("days_id_publish", "days_registration"),
}
REGISTRATION_QUOTIENTS = {
    "employed_registration_percent": ("days_employed", "days_registration"),
    "birth_registration_percent": ("days_birth", "days_registration"),
}
CAR_PHONE_QUOTIENTS = {
    "car_age_emp_percent": ("own_car_age", "days_employed"),
    "car_age_birth_percent": ("own_car_age", "days_birth"),
    "phone_change_emp_percent": ("days_last_phone_change", "days_employed"),
    "phone_change_birth_percent": ("days_last_phone_change", "days_birth"),
}
INCOME_MEDIANS = {
    "name_contract_type": "median_income_contract_type",
    "name_type_suite": "median_income_suite_type",
    "name_housing_type": "median_income_housing_type",
    "organization_type": "median_income_org_type",
    "occupation_type": "median_income_occu_type",
    "name_education_type": "median_income_edu_type",
}
MEDIAN_QUOTIENTS = {
    "org_type_income_percent": "median_income_org_type",
    "occu_type_income_percent": "median_income_occu_type",
    "edu_type_income_percent": "median_income_edu_type",
}
LOAD_COLUMNS = ["ingest_date", "ingest_timestamp"]


def clean_application(df: DataFrame, sentinel: str = "positive") -> DataFrame:
    """Repair an application table.

    ``sentinel`` says how unknown employment is marked: "positive" takes any
    positive day count for it; "maximum" takes the largest value, and treats it
    as unknown in every numeric column.
    """
    if sentinel == "positive":
        df = null_where(df, {"days_employed": F.col("days_employed") > 0})
    elif sentinel == "maximum":
        df = null_maximum_everywhere(df, "days_employed")
    else:
        raise ValueError(f"unknown sentinel rule {sentinel!r}")
    df = fill_nulls(df, TEXT_DEFAULTS)
    df = replace_values(df, REPLACEMENTS)
    df = fill_nulls(df, NUMBER_DEFAULTS)
    return fill_most_frequent(df, "cnt_fam_members")


def income_quotients(df: DataFrame) -> DataFrame:
    return df.withColumns({n: ratio(a, b) for n, (a, b) in QUOTIENTS.items()})


def amount_differences(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.col(a) - F.col(b) for n, (a, b) in DIFFERENCES.items()})


def registration_quotients(df: DataFrame) -> DataFrame:
    out = {n: ratio(a, b) for n, (a, b) in REGISTRATION_QUOTIENTS.items()}
    term = ratio("amt_annuity", "amt_credit")
    return df.withColumns(out | {"annuity_length_employed_percent": ratio(term, "days_employed")})


def age_at_loan_end(df: DataFrame) -> DataFrame:
    """Age in years now plus the years the loan runs."""
    age = -F.col("days_birth") / F.lit(365.0)
    run = ratio("amt_credit", "amt_annuity") / F.lit(12.0)
    return df.withColumns({"age_loan_finish": age + run})


def car_phone_quotients(df: DataFrame) -> DataFrame:
    return df.withColumns({n: ratio(a, b) for n, (a, b) in CAR_PHONE_QUOTIENTS.items()})


def row_features(df: DataFrame) -> DataFrame:
    """All features that need only the row itself; Spark collapses them into one step."""
    steps = (
        income_quotients,
        amount_differences,
        registration_quotients,
        age_at_loan_end,
        car_phone_quotients,
    )
    for step in steps:
        df = step(df)
    return df


# --- medians by category ---------------------------------------------------------


def _by_category(df: DataFrame, value: str, categories) -> DataFrame:
    """Rows (dimension, category, value): all category columns in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("category")) for c in categories]
    )
    return df.select(F.inline(pairs), F.col(value)).where(F.col("category").isNotNull())


def fit_medians(
    df: DataFrame, exact: bool = False, accuracy: int = 10_000, value: str = "amt_income_total"
) -> DataFrame:
    """Median income per value of the six categories: (dimension, category, median).

    The approximate median merges before the shuffle; the exact one is
    interpolated and takes a few more steps.
    """
    long = _by_category(df, value, INCOME_MEDIANS)
    by = ["dimension", "category"]
    if exact:
        return exact_quantiles(long, value, [0.5], by).select(*by, F.col("value").alias("median"))
    return long.groupBy(*by).agg(
        F.percentile_approx(value, 0.5, accuracy).cast("double").alias("median")
    )


def apply_medians(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Join learned medians.

    Read from a table, as an encoder does, their size is known and they are broadcast if
    small, so the application table is not shuffled.
    """
    for category, name in INCOME_MEDIANS.items():
        one = medians.where(F.col("dimension") == category).select(
            F.col("category").alias(category), F.col("median").alias(name)
        )
        df = df.join(one, category, "left")
    return df


def median_quotients(df: DataFrame) -> DataFrame:
    return df.withColumns({n: ratio(m, "amt_income_total") for n, m in MEDIAN_QUOTIENTS.items()})


# --- the composed feature table ------------------------------------------------


@dataclass(frozen=True)
class ApplicationEncoder:
    """What is learned on the training table and applied to any other.

    ``wide`` are category columns with more values than their limit: they are no columns
    of the features but stay in the long form.
    """

    medians: DataFrame
    categories: Mapping[str, list[str]] = field(default_factory=dict)
    keep_documents: tuple[str, ...] = ()
    wide: tuple[str, ...] = ()

    @staticmethod
    def fit(
        cleaned: DataFrame,
        exact_median: bool = False,
        keep_documents: tuple[str, ...] = (),
        limits: Limits = LIMIT,
    ) -> "ApplicationEncoder":
        """``keep_documents`` names document flags that stay in the features."""
        learned = written(ApplicationEncoder.learn(cleaned, exact_median, keep_documents, limits), "learned")
        return ApplicationEncoder.of(learned)

    @staticmethod
    def learn(
        cleaned: DataFrame,
        exact_median: bool = False,
        keep_documents: tuple[str, ...] = (),
        limits: Limits = LIMIT,
    ) -> DataFrame:
        """All that is learned, as rows of one table."""
        source = cleaned.drop(*LOAD_COLUMNS)
        names = columns_of_type(source, T.StringType)
        medians = learned_rows(
            fit_medians(source, exact_median), "application", "median", "dimension", "category", "median"
        )
        documents = cleaned.sparkSession.createDataFrame([(c,) for c in keep_documents], "name string")
        return reduce(
            DataFrame.unionByName,
            [
                medians,
                learned_categories(source, "application", names, limits),
                learned_rows(documents, "application", "document", "name"),
            ],
        )

    @staticmethod
    def of(learned: DataFrame) -> "ApplicationEncoder":
        """From the table; only what names columns comes to the driver."""
        mine = learned.where(F.col("source") == "application")
        medians = mine.where(F.col("part") == "median").select(
            F.col("name").alias("dimension"), F.col("value").alias("category"), F.col("number").alias("median")
        )
        categories, wide = read_categories(learned, "application")
        documents = mine.where(F.col("part") == "document").orderBy("name").collect()
        return ApplicationEncoder(medians, categories, tuple(r["name"] for r in documents), tuple(wide))

    def apply(self, cleaned: DataFrame) -> DataFrame:
        df = row_features(cleaned.drop(*LOAD_COLUMNS))
        df = median_quotients(apply_medians(df, self.medians))
        df = df.drop(*[c for c in DOCUMENT_FLAGS if c not in self.keep_documents], *self.wide)
        return one_hot(df, self.categories)

    def wide_values(self, cleaned: DataFrame, id_col: str = "sk_id_curr") -> DataFrame:
        """Rows (id, name, value) of the wide columns."""
        return category_pairs(cleaned, self.wide, [id_col])


def application_features(
    cleaned: DataFrame, exact_median: bool = False, keep_documents: tuple[str, ...] = ()
) -> DataFrame:
    """Learn and apply on the same table."""
    return ApplicationEncoder.fit(cleaned, exact_median, keep_documents).apply(cleaned)


def write_application_features(
    silver: Lake,
    table: str,
    encoder: ApplicationEncoder | None = None,
    n_files: int | None = None,
    compression: str = "none",
) -> None:
    """Features of a cleaned table, exported as CSV beside it."""
    cleaned = silver.read(f"{table}_clean")
    encoder = encoder or ApplicationEncoder.fit(cleaned)
    export_csv(encoder.apply(cleaned), silver.path(f"{table}_features_csv"), n_files=n_files, compression=compression)
