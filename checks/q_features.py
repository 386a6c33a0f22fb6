"""Cleaning, encoding and feature tables."""

from pyspark.sql import functions as F

from checks import feature_sql as fs
from checks.registry import query
from ledgerloom.operators import cleaning, encoding
from ledgerloom.operators.aggregates import LOOKBACK
from ledgerloom.plans import application, bureau, card, instalments, mart, pos, previous
from ledgerloom.sources import Lake, scratch_folder, written

APP_KEY = "sk_id_curr, ingest_date, amt_credit"

# --- cleaning -----------------------------------------------------------------

query("cln1_sentinel_rule", """SELECT sk_id_curr, amt_credit,
    CASE WHEN days_employed > 0 THEN NULL ELSE days_employed END AS days_employed
    FROM application""")(
    lambda d: cleaning.null_where(
        d.role("application").select("sk_id_curr", "amt_credit", "days_employed"),
        {"days_employed": F.col("days_employed") > 0},
    )
)

query("cln2_sentinel_everywhere", """
    WITH t AS (SELECT max(days_employed) AS m FROM application)
    SELECT sk_id_curr, nullif(days_employed, m) AS days_employed,
      nullif(days_birth, m) AS days_birth, nullif(amt_credit, m) AS amt_credit,
      name_income_type FROM application, t""")(
    lambda d: cleaning.null_maximum_everywhere(
        d.role("application").select(
            "sk_id_curr", "days_employed", "days_birth", "amt_credit", "name_income_type"
        ),
        "days_employed",
    )
)

query("cln3_sentinel_maximum", "SELECT sk_id_prev, {} FROM previous".format(", ".join(
    f"nullif({c}, (SELECT max({c}) FROM previous)) AS {c}" for c in previous.MARKED_DAYS)))(
    lambda d: cleaning.null_maximum(
        d.role("previous").select("sk_id_prev", *previous.MARKED_DAYS), previous.MARKED_DAYS
    )
)

query("cln4_zero_to_null", "SELECT sk_id_prev, nullif(days_first_due, 0) AS days_first_due "
      "FROM previous")(
    lambda d: cleaning.zero_to_null(
        d.role("previous").select("sk_id_prev", "days_first_due"), ["days_first_due"]
    )
)

query("cln5_fill_text", """SELECT sk_id_curr, amt_credit, flag_mobil,
    coalesce(name_family_status, 'Data_Not_Available') AS name_family_status,
    coalesce(name_housing_type, 'Data_Not_Available') AS name_housing_type,
    coalesce(occupation_type, 'Data_Not_Available') AS occupation_type,
    coalesce(name_type_suite, 'Unaccompanied') AS name_type_suite FROM application""")(
    lambda d: cleaning.fill_nulls(
        d.role("application").select(
            "sk_id_curr", "amt_credit", "flag_mobil", "name_family_status", "name_housing_type",
            "occupation_type", "name_type_suite",
        ),
        application.TEXT_DEFAULTS,
    )
)

query("cln6_replace_values", """SELECT sk_id_curr, amt_credit,
    CASE name_family_status WHEN 'Unknown' THEN 'Married' ELSE name_family_status END
      AS name_family_status,
    CASE code_gender WHEN 'XNA' THEN 'M' ELSE code_gender END AS code_gender
    FROM application""")(
    lambda d: cleaning.replace_values(
        d.role("application").select(
            "sk_id_curr", "amt_credit", "name_family_status", "code_gender"
        ),
        application.REPLACEMENTS,
    )
)

query("cln7_fill_numbers", """SELECT sk_id_curr, amt_credit,
    coalesce(amt_annuity, 0) AS amt_annuity, coalesce(amt_goods_price, 0) AS amt_goods_price,
    coalesce(ext_source_1, 0) AS ext_source_1, coalesce(ext_source_2, 0) AS ext_source_2,
    coalesce(ext_source_3, 0) AS ext_source_3 FROM application""")(
    lambda d: cleaning.fill_nulls(
        d.role("application").select("sk_id_curr", "amt_credit", *application.NUMBER_DEFAULTS),
        application.NUMBER_DEFAULTS,
    )
)

query("cln8_fill_mode", """SELECT sk_id_curr, amt_credit, coalesce(cnt_fam_members,
      (SELECT cnt_fam_members FROM application WHERE cnt_fam_members IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS cnt_fam_members FROM application""")(
    lambda d: cleaning.fill_most_frequent(
        d.role("application").select("sk_id_curr", "amt_credit", "cnt_fam_members"),
        "cnt_fam_members",
    )
)

query("cln9_clean_application", fs.APP_CLEAN.format(role="application"))(
    lambda d: application.clean_application(d.role("application"))
)

query("cln10_fill_all_numeric", """
    SELECT c.sk_id_curr, coalesce(b, 0) AS balance, coalesce(n, 0) AS instalments
    FROM (SELECT sk_id_curr, sum(amt_balance) AS b FROM card GROUP BY 1) c
    LEFT JOIN (SELECT sk_id_curr, CAST(sum(cnt_instalment) AS BIGINT) AS n FROM pos
               WHERE sk_dpd > 30 GROUP BY 1) p USING (sk_id_curr)""")(
    lambda d: cleaning.fill_all_numeric(
        d.role("card").groupBy("sk_id_curr").agg(F.sum("amt_balance").alias("balance")).join(
            d.role("pos").where("sk_dpd > 30").groupBy("sk_id_curr")
            .agg(F.sum("cnt_instalment").alias("instalments")),
            "sk_id_curr", "left",
        ),
        keep=["sk_id_curr"],
    )
)

# --- application features ---------------------------------------------------------

APP_INPUTS = [
    "sk_id_curr", "ingest_date", "amt_credit", "amt_annuity", "amt_income_total",
    "amt_goods_price", "cnt_fam_members", "cnt_children", "days_employed", "days_birth",
    "days_registration", "days_id_publish", "own_car_age", "days_last_phone_change",
]
APP_STEPS = {
    "fea1_income_quotients": (application.income_quotients, fs.APP_QUOTIENTS),
    "fea2_differences": (application.amount_differences, fs.APP_DIFFS),
    "fea3_registration_quotients": (application.registration_quotients, fs.APP_REGISTRATION),
    "fea4_age_at_loan_end": (application.age_at_loan_end, fs.APP_AGE),
    "fea5_car_phone_quotients": (application.car_phone_quotients, fs.APP_CAR_PHONE),
}
for _name, (_step, _exprs) in APP_STEPS.items():
    query(_name, f"SELECT {', '.join(APP_INPUTS)}, {fs.extra(_exprs)} FROM application")(
        lambda d, s=_step: s(d.role("application").select(*APP_INPUTS))
    )

MEDIAN_INPUTS = ["sk_id_curr", "amt_credit", "amt_income_total", *application.INCOME_MEDIANS]
MEDIAN_SOURCE = f"(SELECT {', '.join(MEDIAN_INPUTS)} FROM application)"


def _medians(d, exact):
    df = d.role("application").select(*MEDIAN_INPUTS)
    # The checks compare with an exact median, so the sketch is asked for one.
    fitted = written(application.fit_medians(df, exact, accuracy=10_000_000))
    return application.apply_medians(df, fitted)


query("fea6_income_medians", fs.median_sql(MEDIAN_SOURCE))(lambda d: _medians(d, False))
query("fea6_income_medians_exact", fs.median_sql(MEDIAN_SOURCE, "quantile_cont"))(
    lambda d: _medians(d, True)
)
query("fea7_median_quotients", f"""SELECT *, {', '.join(
    f'median_income_{m} / nullif(amt_income_total, 0) AS {m}_income_percent'
    for m in fs.MEDIAN_PERCENTS)} FROM ({fs.median_sql(MEDIAN_SOURCE)})""")(
    lambda d: application.median_quotients(_medians(d, False))
)


def _hot(with_null):
    picks = [f"{fs.flag('p_type', v)} AS p_type_{v}"
             for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "STANDARD")]
    picks += [f"{fs.flag('p_brand', f'Brand#{i}')} AS p_brand_Brand_{i}" for i in range(1, 26)]
    if with_null:
        picks += [f"{fs.null_flag(c)} AS {c}_nan" for c in ("p_brand", "p_type")]
    return f"SELECT p_partkey, p_size, price, {', '.join(picks)} FROM product"


def _one_hot(d, with_null):
    df = d.role("product").drop("tags")
    return encoding.one_hot(df, encoding.fit_categories(df), with_null)


def _hot_none():
    nones = "CAST(0 AS INT) AS p_brand_None, CAST(0 AS INT) AS p_type_None"
    return f"SELECT *, {nones} FROM ({_hot(False)})"


def _indexed(columns):
    values = " UNION ".join(f"SELECT '{c}' AS name, {c} AS value FROM product WHERE {c} IS NOT NULL" for c in columns)
    return f"""(SELECT name, value, row_number() OVER (ORDER BY name, substr(md5(value), 1, 3), value) - 1 AS position
      FROM ({values}))"""


query("fea8_one_hot_with_none", _hot_none())(
    lambda d: encoding.one_hot(
        d.role("product").drop("tags"), encoding.fit_categories(d.role("product").drop("tags")), none_column=True))
query("fea8_long_form", """SELECT * FROM (
      SELECT p_partkey, 'p_brand' AS name, p_brand AS value FROM product UNION ALL
      SELECT p_partkey, 'p_type', p_type FROM product UNION ALL
      SELECT p_partkey, 'tags', tags FROM product) WHERE value IS NOT NULL""")(
    lambda d: encoding.category_pairs(d.role("product"), ["p_brand", "p_type", "tags"], ["p_partkey"]))
query("fea8_value_index", f"SELECT * FROM {_indexed(['p_brand', 'p_type', 'tags'])}")(
    lambda d: encoding.index_values(encoding.category_pairs(d.role("product"), ["p_brand", "p_type", "tags"]))
    .withColumn("position", F.col("position").cast("long")))
query("fea8_sparse_rows", f"""WITH i AS (SELECT * FROM {_indexed(['p_brand', 'p_type', 'tags'])}),
      e AS (SELECT p_partkey, position FROM product JOIN i ON (name = 'p_brand' AND value = p_brand)
        OR (name = 'p_type' AND value = p_type) OR (name = 'tags' AND value = tags))
    SELECT p_partkey, (SELECT count(*) FROM i) AS size, string_agg(position, ',' ORDER BY position) AS indices
    FROM e GROUP BY 1""")(
    lambda d: encoding.sparse_rows(
        d.role("product"), "p_partkey",
        encoding.index_values(encoding.category_pairs(d.role("product"), ["p_brand", "p_type", "tags"])),
        ["p_brand", "p_type", "tags"],
    ).select("p_partkey", "size", F.concat_ws(",", F.col("indices").cast("array<string>")).alias("indices")))
query("fea8_one_hot", _hot(False))(lambda d: _one_hot(d, False))
query("fea9_one_hot_with_null", _hot(True))(lambda d: _one_hot(d, True))
query("fea10_application_features", fs.app_features_sql("application"))(
    lambda d: application.application_features(
        application.clean_application(d.role("application"))
    )
)

# --- bureau -------------------------------------------------------------------------

BUREAU_DIFFS = """SELECT *, days_credit_enddate - days_credit AS credit_duration,
    days_credit_enddate - days_enddate_fact AS enddate_diff,
    days_credit_enddate - days_credit_update AS update_diff,
    amt_credit_sum / nullif(amt_credit_sum_debt, 0) AS debt_percentage,
    amt_credit_sum - amt_credit_sum_debt AS debt_credit_diff,
    amt_credit_sum / nullif(amt_annuity, 0) AS credit_to_annuity_ratio,
    amt_credit_sum_debt / nullif(amt_annuity, 0) AS debt_to_annuity_ratio,
    amt_credit_sum - amt_credit_sum_overdue AS credit_overdue_diff FROM bureau"""
query("feb1_loan_differences", BUREAU_DIFFS)(lambda d: bureau.loan_differences(d.role("bureau")))

PER_CLIENT = """SELECT sk_id_curr, count(sk_id_bureau) AS customer_loan_count,
    count(DISTINCT credit_type) AS customer_credit_types,
    avg(CASE credit_active WHEN 'Closed' THEN 0 WHEN 'Active' THEN 1 ELSE 2 END)
      AS customer_credit_code_mean,
    sum(coalesce(amt_credit_sum, 0)) AS total_credit_sum,
    sum(coalesce(amt_credit_sum_debt, 0)) AS total_debt_sum FROM bureau GROUP BY 1"""
FEW = ["sk_id_curr", "sk_id_bureau", "credit_active", "credit_type", "amt_credit_sum",
       "amt_credit_sum_debt", "amt_annuity"]
SOME = ", ".join(FEW)
query("feb2_loan_counts", f"""SELECT {SOME}, customer_loan_count, customer_credit_types,
    CAST(customer_loan_count AS DOUBLE) / customer_credit_types AS avg_loan_type
    FROM bureau JOIN ({PER_CLIENT}) USING (sk_id_curr)""")(
    lambda d: bureau.loan_counts(d.role("bureau").select(*FEW))
)
query("feb3_status_codes", f"""SELECT {SOME},
    CASE credit_active WHEN 'Closed' THEN 0 WHEN 'Active' THEN 1 ELSE 2 END AS credit_type_code,
    customer_credit_code_mean FROM bureau JOIN ({PER_CLIENT}) USING (sk_id_curr)""")(
    lambda d: bureau.status_codes(d.role("bureau").select(*FEW))
)
query("feb4_loan_totals", f"""SELECT {SOME}, total_credit_sum, total_debt_sum,
    total_credit_sum / nullif(total_debt_sum, 0) AS credit_debt_ratio
    FROM ({fs.BUREAU_FILLED.format(source='bureau')}) JOIN ({PER_CLIENT}) USING (sk_id_curr)""")(
    lambda d: bureau.loan_totals(d.role("bureau").select(*FEW))
)
query("feb5_balance_per_loan", fs.BALANCE_SQL)(
    lambda d: bureau.balance_per_loan(d.role("bureau_balance"), fs.STATUSES)
)
BUREAU_ALL = fs.bureau_items()
query("feb6_client_figures",
      f"SELECT sk_id_curr, {', '.join(BUREAU_ALL)} FROM {fs.BUREAU_ROWS} GROUP BY 1",
      round_=[n for n in fs.names_of(BUREAU_ALL) if n in fs.BUREAU_INEXACT])(
    lambda d: bureau.loans_with_balance(d.role("bureau"), d.role("bureau_balance"), fs.STATUSES)
    .groupBy("sk_id_curr")
    .agg(*bureau.client_measures(fs.BUREAU_CATEGORIES, fs.STATUSES))
)
BUREAU_SCOPED = fs.bureau_scoped("c_", "Closed") + fs.bureau_scoped("a_", "Active")
query("feb7_active_and_closed",
      f"SELECT sk_id_curr, {', '.join(BUREAU_SCOPED)} FROM {fs.BUREAU_ROWS} GROUP BY 1",
      round_=[n for n in fs.names_of(BUREAU_SCOPED) if n in fs.BUREAU_INEXACT])(
    lambda d: bureau.loans_with_balance(d.role("bureau"), d.role("bureau_balance"), fs.STATUSES)
    .groupBy("sk_id_curr")
    .agg(*bureau.scoped_measures(active=True))
)

# --- previous applications -------------------------------------------------------------


def _prev_inexact(sql_names):
    return [n for n in sql_names if any(n.startswith(i) for i in fs.PREV_INEXACT)]


query("fep1_row_features", f"{fs.PREV_ROWS} previous")(
    lambda d: previous.row_features(d.role("previous"))
)
for _key, _parts in (("fep2_client_figures", ("all",)), ("fep3_approved_and_refused", ("scopes",))):
    _sql, _names = fs.prev_sql(f"({fs.PREV_CLEAN})", _parts)

    def _prev(d, parts=_parts):
        rows = previous.row_features(previous.clean_previous(d.role("previous")))
        found = (
            previous.client_measures(fs.PREV_CATEGORIES)
            if parts == ("all",)
            else previous.scoped_measures()
        )
        return rows.groupBy("sk_id_curr").agg(*found)

    query(_key, _sql, round_=_prev_inexact(_names))(_prev)

PREV_WIDE_NAMES = [n + s for s, _ in fs.DAYS for n in fs.names_of(fs.prev_items())]
query("fep4_lookbacks", fs.PREV_WIDE, round_=_prev_inexact(PREV_WIDE_NAMES))(
    lambda d: previous.previous_features(
        *(lambda p: (previous.clean_previous(p), previous.fit_previous(p)))(
            d.role("previous"))
    )
)

# --- point of sale ------------------------------------------------------------------------

_sql, _ = fs.pos_month_sql("pos")
query("fec1_month_figures", _sql)(
    lambda d: d.role("pos").groupBy("sk_id_curr").agg(*pos.client_measures(fs.POS_CATEGORIES))
)
_sql, _ = fs.pos_loan_sql("pos")
query("fec2_loan_figures", _sql, round_=fs.POS_INEXACT)(lambda d: pos.loans_per_client(d.role("pos")))
query("fec3_lookbacks", fs.POS_WIDE,
      round_=[n + s for s, _ in fs.MONTHS for n in fs.POS_INEXACT])(
    lambda d: pos.pos_features(d.role("pos"), pos.fit_pos(d.role("pos")))
)

# --- instalments -----------------------------------------------------------------------------

PAYMENT = ["sk_id_curr", "sk_id_prev", "num_instalment_version", "num_instalment_number",
           "days_instalment", "days_entry_payment", "amt_instalment", "amt_payment"]
PAYMENTS = ", ".join(PAYMENT)
query("fei1_payment_totals", f"""SELECT {PAYMENTS}, amt_payment_grouped, payment_difference,
    amt_instalment / nullif(amt_payment_grouped, 0) AS payment_ratio, paid_over_amount,
    CASE WHEN paid_over_amount > 0 THEN 1 ELSE 0 END AS paid_over
    FROM ({fs.ins_rows('instalments')})""")(
    lambda d: instalments.payment_totals(d.role("instalments"))
)
query("fei2_delays", f"""SELECT {PAYMENTS}, dpd, dbd, late_payment
    FROM ({fs.ins_rows('instalments')})""")(lambda d: instalments.delays(d.role("instalments")))
query("fei2_delays_late_on_dpd", f"""SELECT {PAYMENTS}, dpd, dbd, late_payment
    FROM ({fs.ins_rows('instalments', 'dpd')})""")(
    lambda d: instalments.delays(d.role("instalments"), "dpd")
)
query("fei3_late_ratios", f"""SELECT {PAYMENTS}, dpd, dbd, late_payment, instalment_payment_ratio,
    late_payment_ratio, CASE WHEN late_payment_ratio > 0.05 THEN 1 ELSE 0 END
      AS significant_late_payment FROM ({fs.ins_rows('instalments')})""")(
    lambda d: instalments.late_ratios(instalments.delays(d.role("instalments")))
)
BOUNDS = {"7": 7, "15": 15, "30": 30, "60": 60, "90": 90, "180": 180, "wof": 720}
query("fei4_late_buckets", f"""SELECT {PAYMENTS}, dpd, dbd, late_payment, {', '.join(
    f'CASE WHEN dpd >= {b} THEN 1 ELSE 0 END AS dpd_{n}' for n, b in BOUNDS.items())}
    FROM ({fs.ins_rows('instalments')})""")(
    lambda d: instalments.late_buckets(instalments.delays(d.role("instalments")))
)
query("fei5_client_figures", fs.ins_sql(f"({fs.INS_CLEAN})")[0])(
    lambda d: instalments.per_client(instalments.clean_instalments(d.role("instalments")))
)
query("fei5_client_figures_from_rows", fs.ins_sql(f"({fs.INS_CLEAN})")[0])(
    lambda d: instalments.per_client_rows(
        instalments.row_features(instalments.clean_instalments(d.role("instalments")))
    )
)
query("fei6_lookbacks", fs.INS_WIDE)(
    lambda d: instalments.instalment_features(d.role("instalments"))
)

# --- card ---------------------------------------------------------------------------------------

query("fek1_row_features", fs.CARD_ROWS.format(source="card"))(
    lambda d: card.row_features(d.role("card"))
)
query("fek2_client_figures", fs.card_sql("card")[0], round_=fs.CARD_INEXACT)(
    lambda d: card.per_client(d.role("card"), card.fit_card(d.role("card")))
)
CARD_WIDE_INEXACT = [n + s for s, _ in fs.MONTHS for n in fs.CARD_INEXACT]
query("fek3_lookbacks", fs.CARD_WIDE, round_=CARD_WIDE_INEXACT)(
    lambda d: card.card_features(d.role("card"), card.fit_card(d.role("card")))
)

# --- everything ------------------------------------------------------------------------------------

BUREAU_SQL, BUREAU_NAMES = fs.bureau_sql()
MART_PARTS = {"bur": BUREAU_SQL, "prv": fs.PREV_WIDE, "cash": fs.POS_WIDE, "inst": fs.INS_WIDE,
              "crd": fs.CARD_WIDE}


def mart_sql(app):
    return """WITH app AS ({}), {} SELECT * FROM app {}""".format(
        app,
        ", ".join(f"{n} AS ({sql})" for n, sql in MART_PARTS.items()),
        " ".join(f"LEFT JOIN {n} USING (sk_id_curr)" for n in MART_PARTS),
    )


MART_SQL = mart_sql(fs.app_features_sql("applicant", ("flag_document_3",)))
MART_INEXACT = (
    [n for n in BUREAU_NAMES if n in fs.BUREAU_INEXACT]
    + _prev_inexact(PREV_WIDE_NAMES)
    + [n + s for s, _ in fs.MONTHS for n in fs.POS_INEXACT]
    + CARD_WIDE_INEXACT
)


def sources(d) -> mart.Sources:
    return mart.Sources(*d.roles("bureau", "bureau_balance", "previous", "pos", "instalments", "card"))


@query("fem1_feature_mart", MART_SQL, round_=MART_INEXACT)
def _mart(d):
    cleaned = application.clean_application(d.role("applicant"))
    details = sources(d)
    return mart.feature_mart(cleaned, details, mart.MartEncoder.fit(cleaned, details))


@query("fem1_mart_of_newcomers", mart_sql(fs.app_features_sql("newcomer", ("flag_document_3",), "applicant")),
       round_=MART_INEXACT)
def _mart_of_newcomers(d):
    """Learned on applicants and kept; loaded by name and applied to others, of unknown and absent categories."""
    base, details = scratch_folder(d.spark, "fem1"), sources(d)
    mart.MartEncoder.fit_and_save(
        Lake(d.spark, base), "mart", application.clean_application(d.role("applicant")), details)
    encoder = mart.MartEncoder.load(Lake(d.spark, base), "mart")
    return mart.feature_mart(application.clean_application(d.role("newcomer")), details, encoder)


# --- the windows themselves ----------------------------------------------------------------------

query("flt4_day_windows", """SELECT w.lookback, count(*) AS n, count(DISTINCT sk_id_curr) AS clients
    FROM previous JOIN (VALUES (0, 100000), (1, 365), (2, 182), (3, 90), (4, 30), (5, 14), (6, 7))
      w(lookback, reach) ON days_decision >= -reach GROUP BY 1""")(
    lambda d: previous.LOOKBACKS.expand(d.role("previous")).groupBy(LOOKBACK).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("sk_id_curr").alias("clients")
    )
)
query("flt5_month_windows", """SELECT w.lookback, count(*) AS n, count(DISTINCT sk_id_curr) AS clients
    FROM pos JOIN (VALUES (0, 100000), (1, 12), (2, 6), (3, 3), (4, 1))
      w(lookback, reach) ON months_balance >= -reach GROUP BY 1""")(
    lambda d: pos.LOOKBACKS.expand(d.role("pos")).groupBy(LOOKBACK).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("sk_id_curr").alias("clients")
    )
)
