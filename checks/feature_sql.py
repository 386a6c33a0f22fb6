"""Check SQL of the wide feature tables, generated from what they aggregate.

Look-back windows are written as one filtered aggregate per window, joined on
the client: another shape than the Spark side uses.
"""

from __future__ import annotations

import re

DAYS = [("", None), ("_year", 365), ("_half_year", 182), ("_quarter", 90), ("_month", 30),
        ("_fortnight", 14), ("_week", 7)]
MONTHS = [("", None), ("_year", 12), ("_half_year", 6), ("_quarter", 3), ("_month", 1)]


def safe(v):
    return re.sub(r"[^0-9A-Za-z_]", "_", v)


def agg(fn, col, whole=False, where=None, size_as="BIGINT"):
    """One aggregate; ``whole`` marks integer columns, whose sums are BIGINT."""
    f = f" FILTER (WHERE {where})" if where else ""
    if fn in ("min", "max"):
        return f"{fn}({col}){f}"
    if fn == "mean":
        return f"avg({col}){f}"
    if fn == "var":
        return f"var_samp({col}){f}"
    if fn == "size":
        body = f"count(*){f}"
    elif fn == "nunique":
        return f"count(DISTINCT {col}){f}"
    else:
        body = f"coalesce(sum({col}){f}, 0)"
        body = f"CAST({body} AS {'BIGINT' if whole else 'DOUBLE'})"
    return f"CASE WHEN count(*){f} > 0 THEN {body} END" if where else body


def spec_sql(spec, prefix, whole=(), where=None):
    return [
        f"{agg(fn, c, c in whole, where)} AS {prefix}{c}_{fn}"
        for c, fns in spec.items()
        for fn in fns
    ]


def flag(col, value):
    return f"CASE WHEN {col} = '{value}' THEN 1 ELSE 0 END"


def null_flag(col):
    return f"CASE WHEN {col} IS NULL THEN 1 ELSE 0 END"


def shares_sql(categories, prefix):
    out = []
    for c, values in categories.items():
        out += [f"avg({flag(c, v)}) AS {prefix}{c}_{safe(v)}_mean" for v in values]
        out.append(f"avg({null_flag(c)}) AS {prefix}{c}_nan_mean")
    return out


def names_of(items):
    return [i.rsplit(" AS ", 1)[1] for i in items]


def windowed(source, offset, windows, build, key="sk_id_curr"):
    """Join one aggregate per window; ``build(text)`` gives (select items, FROM text)."""
    ctes, picks, joins = [], [], ""
    for i, (suffix, reach) in enumerate(windows):
        where = "" if reach is None else f" WHERE {offset} >= -{reach}"
        sub, names = build(f"(SELECT * FROM {source}{where})")
        ctes.append(f"w{i} AS MATERIALIZED ({sub})")
        picks += [f"w{i}.{n} AS {n}{suffix}" for n in names]
        if i:
            joins += f" LEFT JOIN w{i} ON w0.{key} = w{i}.{key}"
    return f"WITH {', '.join(ctes)} SELECT w0.{key}, {', '.join(picks)} FROM w0{joins}"


# --- previous applications -------------------------------------------------------

PREV_MARKED = ["days_first_drawing", "days_first_due", "days_last_due_1st_version",
               "days_last_due", "days_termination"]
# The functions over each column.
PREV_SPEC = {
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
PREV_CATEGORIES = {
    "name_contract_type": ["Cash loans", "Consumer loans"],
    "weekday_appr_process_start": [f"DAY {i}" for i in range(7)],
    "flag_last_appl_per_contract": ["N", "Y"],
    "name_cash_loan_purpose": [f"Purpose {i}" for i in range(4)],
    "name_contract_status": ["Approved", "Canceled", "Refused"],
    "name_payment_type": ["Cash"],
    "code_reject_reason": ["LIMIT", "XAP"],
    "name_type_suite": ["Family"],
    "name_client_type": ["New", "Repeater"],
    "name_goods_category": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "name_portfolio": ["POS"],
    "name_product_type": ["walk-in", "x-sell"],
    "channel_type": [f"Channel {i}" for i in range(3)],
    "name_seller_industry": ["Industry", "Trade"],
    "name_yield_group": ["high", "middle"],
    "product_combination": [f"Cash {i}" for i in range(3)],
}
PREV_CLEAN = "SELECT * REPLACE ({}) FROM previous".format(", ".join(
    "nullif({0}, (SELECT max({0}) FROM previous)) AS {0}".format(c) if c == PREV_MARKED[0] else
    "nullif(nullif({0}, 0), (SELECT max(nullif({0}, 0)) FROM previous)) AS {0}".format(c)
    for c in PREV_MARKED))
PREV_ROWS = """SELECT *, amt_application - amt_credit AS application_credit_diff,
  amt_application / nullif(amt_credit, 0) AS application_credit_ratio,
  amt_credit / nullif(amt_annuity, 0) AS credit_to_annuity_ratio,
  amt_down_payment / nullif(amt_credit, 0) AS down_payment_to_credit,
  (amt_annuity * cnt_payment / nullif(amt_credit, 0) - 1) / nullif(cnt_payment, 0)
    AS simple_interests,
  days_last_due_1st_version - days_last_due AS days_last_due_diff FROM """


def prev_items(parts=("all", "scopes")):
    items = []
    if "all" in parts:
        items += spec_sql(PREV_SPEC, "prev_", {"cnt_payment"}) + shares_sql(PREV_CATEGORIES, "prev_")
    if "scopes" in parts:
        for prefix, status in (("cs_app_", "Approved"), ("cs_ref_", "Refused")):
            items += spec_sql(PREV_SPEC, prefix, {"cnt_payment"}, f"name_contract_status = '{status}'")
    return items


def prev_sql(source, parts=("all", "scopes")):
    items = prev_items(parts)
    sql = f"SELECT sk_id_curr, {', '.join(items)} FROM ({PREV_ROWS}{source}) GROUP BY sk_id_curr"
    return sql, names_of(items)


PREV_WIDE = windowed(f"({PREV_CLEAN})", "days_decision", DAYS, prev_sql)
PREV_INEXACT = [n for n in names_of(prev_items()) if "_ratio_" in n or "_to_credit_" in n]

# --- point of sale ----------------------------------------------------------------

POS_SPEC = {
    "sk_dpd_def": ["max", "mean", "min"], "sk_dpd": ["max", "mean", "min"],
    "months_balance": ["max", "mean", "size"], "cnt_instalment": ["max", "size"],
    "cnt_instalment_future": ["max", "size", "sum"]}
POS_CATEGORIES = {"name_contract_status": ["Active", "Completed", "Signed / new"]}


def pos_month_sql(source):
    items = spec_sql(POS_SPEC, "pos_", {"cnt_instalment_future"}) + shares_sql(POS_CATEGORIES, "pos_")
    return f"SELECT sk_id_curr, {', '.join(items)} FROM {source} GROUP BY 1", names_of(items)


def pos_loan_sql(source):
    """First and last by sorted lists, ties by value."""
    def pick(col, order, at):
        return (f"list({col} ORDER BY months_balance {order}, {col} {order}) "
                f"FILTER (WHERE {col} IS NOT NULL)[{at}]").replace("list(", "(list(").replace(
                    f")[{at}]", f"))[{at}]")
    inner = f"""SELECT sk_id_curr, sk_id_prev,
        avg(CASE WHEN name_contract_status = 'Completed' THEN 1 ELSE 0 END) AS done,
        {pick('cnt_instalment', 'ASC', 1)} AS a, {pick('cnt_instalment', 'DESC', 1)} AS z,
        {pick('cnt_instalment_future', 'DESC', 1)} AS left_over
      FROM {source} GROUP BY 1, 2"""
    items = [
        "coalesce(sum(done), 0) AS pos_loan_completed_mean",
        "CAST(coalesce(sum(CASE WHEN a - z > 0 AND done > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) "
        "AS pos_completed_before_mean",
        "CAST(coalesce(sum(left_over), 0) AS BIGINT) AS pos_remaining_instalments",
        "coalesce(sum(left_over / nullif(z, 0)), 0) AS pos_remaining_instalments_ratio",
    ]
    return f"SELECT sk_id_curr, {', '.join(items)} FROM ({inner}) GROUP BY 1", names_of(items)


def pos_sql(source):
    months, a = pos_month_sql(source)
    loans, b = pos_loan_sql(source)
    return (f"SELECT m.sk_id_curr, {', '.join(a + b)} FROM ({months}) m "
            f"LEFT JOIN ({loans}) l ON m.sk_id_curr = l.sk_id_curr"), a + b


POS_INEXACT = ["pos_loan_completed_mean", "pos_remaining_instalments_ratio"]
POS_WIDE = windowed("pos", "months_balance", MONTHS, pos_sql)

# --- instalments ------------------------------------------------------------------

INS_SPEC = {
    "late_payment": ["max", "mean", "min"], "amt_payment": ["min", "max", "mean", "sum"],
    "num_instalment_version": ["nunique"], "num_instalment_number": ["max"],
    "amt_instalment": ["max", "mean", "sum"],
    "payment_difference": ["max", "mean", "min", "sum"],
    "days_entry_payment": ["max", "mean", "sum"], "paid_over_amount": ["max", "mean", "min"]}
INS_CLEAN = """SELECT * REPLACE (coalesce(days_entry_payment, 0) AS days_entry_payment,
  coalesce(amt_payment, 0) AS amt_payment) FROM instalments"""


def ins_rows(source, late="dbd"):
    days = "days_entry_payment - days_instalment"
    base = f"""SELECT *, coalesce(sum(amt_payment) OVER
        (PARTITION BY sk_id_prev, num_instalment_number), 0) AS amt_payment_grouped,
      amt_payment - amt_instalment AS paid_over_amount,
      CASE WHEN {days} <= 0 THEN 0 ELSE {days} END AS dpd,
      CASE WHEN -({days}) <= 0 THEN 0 ELSE -({days}) END AS dbd,
      amt_payment / nullif(amt_instalment, 0) AS instalment_payment_ratio FROM {source}"""
    return f"""SELECT *, amt_instalment - amt_payment_grouped AS payment_difference,
      CASE WHEN {late} > 0 THEN 1 ELSE 0 END AS late_payment,
      CASE WHEN {late} > 0 THEN instalment_payment_ratio ELSE 0 END AS late_payment_ratio
      FROM ({base})"""


def ins_sql(source):
    items = spec_sql(INS_SPEC, "ins_", {"days_entry_payment"}) + ["count(*) AS installation_count"]
    return f"SELECT sk_id_curr, {', '.join(items)} FROM ({ins_rows(source)}) GROUP BY 1", names_of(items)


INS_WIDE = windowed(f"({INS_CLEAN})", "days_instalment", DAYS, ins_sql)

# --- card ----------------------------------------------------------------------------

CARD_WHOLE = ["months_balance", "cnt_drawings_atm_current", "cnt_drawings_current",
              "cnt_drawings_other_current", "cnt_drawings_pos_current",
              "cnt_instalment_mature_cum", "sk_dpd", "sk_dpd_def", "late_payment"]
CARD_AMOUNTS = ["amt_balance", "amt_credit_limit_actual", "amt_drawings_atm_current",
                "amt_drawings_current", "amt_drawings_other_current", "amt_drawings_pos_current",
                "amt_inst_min_regularity", "amt_payment_current", "amt_payment_total_current",
                "amt_receivable_principal", "amt_receivable", "amt_total_receivable"]
CARD_RATIOS = ["limit_use", "payment_div_min", "drawing_limit_ratio"]
CARD_FLAGS = {"name_contract_status_Active": flag("name_contract_status", "Active"),
              "name_contract_status_Sent_proposal": flag("name_contract_status", "Sent proposal"),
              "name_contract_status_nan": null_flag("name_contract_status")}
CARD_ROWS = """SELECT *, amt_balance / nullif(amt_credit_limit_actual, 0) AS limit_use,
  amt_payment_current / nullif(amt_inst_min_regularity, 0) AS payment_div_min,
  CASE WHEN sk_dpd > 0 THEN 1 ELSE 0 END AS late_payment,
  amt_drawings_atm_current / nullif(amt_credit_limit_actual, 0) AS drawing_limit_ratio
  FROM (SELECT * EXCLUDE (amt_recivable), amt_recivable AS amt_receivable FROM {source})"""
FOUR = ["max", "mean", "sum", "var"]


def card_items():
    items = spec_sql({c: FOUR for c in CARD_AMOUNTS + CARD_RATIOS + CARD_WHOLE}, "cr_", CARD_WHOLE)
    for name, expr in CARD_FLAGS.items():
        items += [f"{agg(f, expr, True)} AS cr_{name}_{f}" for f in FOUR]
    return items + ["count(*) AS credit_count"]


def card_sql(source):
    items = card_items()
    return (f"SELECT sk_id_curr, {', '.join(items)} FROM ({CARD_ROWS.format(source=source)}) "
            "GROUP BY 1"), names_of(items)


CARD_INEXACT = [n for n in names_of(card_items())
                if n.endswith("_var") or any(r in n for r in CARD_RATIOS)]
CARD_WIDE = windowed("card", "months_balance", MONTHS, card_sql)

# --- bureau -----------------------------------------------------------------------------

BUREAU_SPEC = {
    "amt_credit_sum_debt": ["mean", "sum"], "amt_credit_sum_overdue": ["mean", "sum"],
    "days_credit": ["mean", "var"], "days_credit_update": ["mean", "min"],
    "credit_day_overdue": ["mean", "min"], "days_credit_enddate": ["mean"],
    "cnt_credit_prolong": ["sum"], "months_balance_size": ["mean", "sum"],
    "amt_credit_sum_limit": ["mean", "sum"], "amt_credit_max_overdue": ["mean", "max"],
    "amt_annuity": ["max", "mean", "sum"], "amt_credit_sum": ["mean", "sum", "max"]}
BUREAU_CATEGORIES = {
    "credit_active": ["Active", "Closed", "Sold"],
    "credit_currency": ["currency 1", "currency 2"],
    "credit_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}
STATUSES = ["0", "1", "2", "3", "4", "5", "6", "C", "X"]
STATUS_FLAGS = {f"status_{s}": flag("status", s) for s in STATUSES} | {
    "status_nan": null_flag("status")}


def balance_items():
    items = ["min(months_balance) AS months_balance_min", "max(months_balance) AS months_balance_max",
             "avg(months_balance) AS months_balance_mean", "count(*) AS months_balance_size"]
    for name, expr in STATUS_FLAGS.items():
        items += [f"min({expr}) AS {name}_min", f"max({expr}) AS {name}_max",
                  f"avg({expr}) AS {name}_mean", f"count(*) AS {name}_size"]
    return items


BALANCE_SQL = f"SELECT sk_id_bureau, {', '.join(balance_items())} FROM bureau_balance GROUP BY 1"
BUREAU_FILLED = """SELECT * REPLACE (coalesce(amt_credit_sum, 0) AS amt_credit_sum,
  coalesce(amt_credit_sum_debt, 0) AS amt_credit_sum_debt,
  coalesce(amt_annuity, 0) AS amt_annuity) FROM {source}"""
BUREAU_ROWS = f"({BUREAU_FILLED.format(source='bureau')}) LEFT JOIN ({BALANCE_SQL}) USING (sk_id_bureau)"
BUREAU_WHOLE = {"cnt_credit_prolong", "months_balance_size"}


def bureau_items():
    items = spec_sql(BUREAU_SPEC, "bureau_", BUREAU_WHOLE)
    for c, values in BUREAU_CATEGORIES.items():
        items += [f"max({flag(c, v)}) AS bureau_{c}_{safe(v)}_max" for v in values]
        items.append(f"max({null_flag(c)}) AS bureau_{c}_nan_max")
    for name in STATUS_FLAGS:
        items += [f"avg({name}_mean) AS bureau_{name}_mean_mean",
                  f"min({name}_min) AS bureau_{name}_min_min",
                  f"max({name}_max) AS bureau_{name}_max_max"]
    return items


def bureau_scoped(prefix, status):
    return spec_sql(BUREAU_SPEC, prefix, BUREAU_WHOLE, f"credit_active = '{status}'")


def bureau_sql(active=False):
    items = bureau_items() + bureau_scoped("c_", "Closed")
    if active:
        items += bureau_scoped("a_", "Active")
    return f"SELECT sk_id_curr, {', '.join(items)} FROM {BUREAU_ROWS} GROUP BY 1", names_of(items)


BUREAU_INEXACT = [n for n in bureau_sql(True)[1] if n.endswith(("_var", "_mean_mean"))]

# --- application ----------------------------------------------------------------------

APP_CLEAN = """SELECT * REPLACE (
    CASE WHEN days_employed > 0 THEN NULL ELSE days_employed END AS days_employed,
    CASE WHEN coalesce(name_family_status, 'Data_Not_Available') = 'Unknown' THEN 'Married'
      ELSE coalesce(name_family_status, 'Data_Not_Available') END AS name_family_status,
    coalesce(name_housing_type, 'Data_Not_Available') AS name_housing_type,
    coalesce(occupation_type, 'Data_Not_Available') AS occupation_type,
    coalesce(name_type_suite, 'Unaccompanied') AS name_type_suite,
    CASE WHEN code_gender = 'XNA' THEN 'M' ELSE code_gender END AS code_gender,
    coalesce(amt_annuity, 0) AS amt_annuity, coalesce(amt_goods_price, 0) AS amt_goods_price,
    coalesce(ext_source_1, 0) AS ext_source_1, coalesce(ext_source_2, 0) AS ext_source_2,
    coalesce(ext_source_3, 0) AS ext_source_3,
    coalesce(cnt_fam_members, (SELECT cnt_fam_members FROM {role}
      WHERE cnt_fam_members IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
      AS cnt_fam_members) FROM {role}"""
APP_QUOTIENTS = {
    "credit_income_percent": "amt_credit / nullif(amt_income_total, 0)",
    "annuity_income_percent": "amt_annuity / nullif(amt_income_total, 0)",
    "credit_annuity_percent": "amt_credit / nullif(amt_annuity, 0)",
    "family_cnt_income_percent": "amt_income_total / nullif(cnt_fam_members, 0)",
    "credit_term": "amt_annuity / nullif(amt_credit, 0)",
    "birth_employed_percent": "days_employed / nullif(days_birth, 0)",
    "children_cnt_income_percent": "amt_income_total / nullif(cnt_children, 0)"}
APP_DIFFS = {"credit_goods_diff": "amt_credit - amt_goods_price",
             "id_registration_diff": "days_id_publish - days_registration"}
APP_REGISTRATION = {
    "employed_registration_percent": "days_employed / nullif(days_registration, 0)",
    "birth_registration_percent": "days_birth / nullif(days_registration, 0)",
    "annuity_length_employed_percent":
        "(amt_annuity / nullif(amt_credit, 0)) / nullif(days_employed, 0)"}
APP_AGE = {"age_loan_finish":
           "-days_birth / CAST(365 AS DOUBLE) + amt_credit / nullif(amt_annuity, 0) / CAST(12 AS DOUBLE)"}
APP_CAR_PHONE = {
    "car_age_emp_percent": "own_car_age / nullif(days_employed, 0)",
    "car_age_birth_percent": "own_car_age / nullif(days_birth, 0)",
    "phone_change_emp_percent": "days_last_phone_change / nullif(days_employed, 0)",
    "phone_change_birth_percent": "days_last_phone_change / nullif(days_birth, 0)"}
APP_ROW = APP_QUOTIENTS | APP_DIFFS | APP_REGISTRATION | APP_AGE | APP_CAR_PHONE
MEDIANS = {"name_contract_type": "contract_type", "name_type_suite": "suite_type",
           "name_housing_type": "housing_type", "organization_type": "org_type",
           "occupation_type": "occu_type", "name_education_type": "edu_type"}
MEDIAN_PERCENTS = ["org_type", "occu_type", "edu_type"]


def extra(exprs):
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


def median_sql(source, quantile="quantile_disc", fitted_on=None):
    """``source`` with the six medians, of itself or of another table, by lookup tables."""
    joins, picks = "", []
    for c, name in MEDIANS.items():
        joins += (f" LEFT JOIN (SELECT {c} AS k, {quantile}(amt_income_total, 0.5) AS m "
                  f"FROM {fitted_on or source} GROUP BY 1) m_{name} ON t.{c} = m_{name}.k")
        picks.append(f"m_{name}.m AS median_income_{name}")
    return f"SELECT t.*, {', '.join(picks)} FROM {source} t{joins}"


APP_CATEGORIES = {
    "name_type_suite": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "Unaccompanied"],
    "name_income_type": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "name_education_type": [f"Education {i}" for i in range(5)],
    "name_family_status": ["Data_Not_Available", "Married"] + [
        f"NATION_{i}" for i in range(25) if i not in (3, 7)],
    "name_housing_type": ["AFRICA", "AMERICA", "Data_Not_Available", "EUROPE", "MIDDLE EAST"],
    "occupation_type": ["Data_Not_Available"] + [f"Job / {i}" for i in range(1, 7)],
    "organization_type": [f"Org: {i}" for i in range(12)],
    "weekday_appr_process_start": [f"DAY {i}" for i in range(7)],
    "code_gender": ["F", "M"],
    "flag_own_car": ["N", "Y"],
    "flag_own_realty": ["N", "Y"],
}
APP_CONTRACTS = {
    "application": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "applicant": ["Cash loans", "Revolving loans"]}


def app_features_sql(role, keep_documents=(), fitted_on=None):
    """Features of a role, with medians and categories of itself or of another role."""
    categories = {"name_contract_type": APP_CONTRACTS[fitted_on or role]} | APP_CATEGORIES
    hot = [f"{flag(c, v)} AS {c}_{safe(v)}" for c, vs in categories.items() for v in vs]
    percents = [f"median_income_{m} / nullif(amt_income_total, 0) AS {m}_income_percent"
                for m in MEDIAN_PERCENTS]
    gone = list(categories) + ["ingest_date"] + [
        f"flag_document_{i}" for i in range(2, 22) if f"flag_document_{i}" not in keep_documents]
    train = f"train AS MATERIALIZED ({APP_CLEAN.format(role=fitted_on)})," if fitted_on else ""
    return f"""WITH cleaned AS MATERIALIZED ({APP_CLEAN.format(role=role)}), {train}
      med AS ({median_sql('cleaned', fitted_on='train' if fitted_on else None)})
      SELECT * EXCLUDE ({', '.join(gone)}), {extra(APP_ROW)}, {', '.join(percents)},
        {', '.join(hot)} FROM med"""
