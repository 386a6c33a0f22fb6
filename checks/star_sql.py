"""Dimensions and facts in the checking engine's SQL, over the roles."""

KEY = "CAST(strftime(ingest_date, '%Y%m%d') AS INT)"
DOCS = [f"flag_document_{i}" for i in range(2, 22)]
REQS = [f"amt_req_credit_bureau_{p}" for p in ("hour", "day", "week", "mon", "qrt", "year")]


def _flag(c):
    return f"CAST(CASE {c} WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS INT) AS {c}"


def _date(c, name):
    return f"CAST(ingest_date + CAST(trunc({c}) AS INT) AS DATE) AS {name}"


def half_up(x, digits, before=15):
    """Decimal rounding: ties go up whatever the double beneath them looks like."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, {before})), {digits}) AS DOUBLE)"


STAR_SQL = {
    "dim_date": f"""
    SELECT DISTINCT ingest_date AS application_date, {KEY} AS date_id,
      CAST(year(ingest_date) AS INT) AS year, CAST(month(ingest_date) AS INT) AS month,
      CAST(day(ingest_date) AS INT) AS day, CAST(dayofweek(ingest_date) + 1 AS INT) AS weekday
    FROM application""",
    "dim_client": f"""
    SELECT DISTINCT sk_id_curr, code_gender, cnt_children, {_flag('flag_own_car')},
      {_flag('flag_own_realty')}, name_income_type, name_education_type, name_family_status,
      cnt_fam_members, name_housing_type, region_population_relative, region_rating_client,
      region_rating_client_w_city FROM application""",
    "dim_contract": f"""
    SELECT DISTINCT sk_id_curr, {KEY} AS application_date_id, name_contract_type,
      name_type_suite, amt_credit, amt_annuity, amt_goods_price,
      {half_up('amt_credit / nullif(amt_income_total, 0)', 4)} AS credit_income_ratio,
      {half_up('amt_annuity / nullif(amt_credit, 0)', 4)} AS annuity_credit_ratio FROM application""",
    "dim_employment": f"""
    SELECT DISTINCT sk_id_curr, {KEY} AS application_date_id,
      CAST(floor(-days_employed / 365) AS INT) AS employment_years, occupation_type,
      organization_type FROM application""",
    "dim_ext_source": f"""
    SELECT DISTINCT sk_id_curr, {KEY} AS application_date_id, ext_source_1, ext_source_2,
      ext_source_3, (ext_source_1 + ext_source_2 + ext_source_3) / 3 AS ext_source_mean,
      greatest(ext_source_1, ext_source_2, ext_source_3) AS ext_source_max FROM application""",
    "dim_document_flags": f"""
    SELECT DISTINCT sk_id_curr, {KEY} AS application_date_id, {', '.join(DOCS)},
      {' + '.join(DOCS)} AS num_docs_provided FROM application""",
    "dim_cb_requests": f"""
    SELECT DISTINCT sk_id_curr, {KEY} AS application_date_id, {', '.join(REQS)}
    FROM application""",
    "fact_application": f"""
    SELECT sk_id_curr, {KEY} AS application_date_id, target FROM application""",
    "fact_bureau": f"""
    SELECT sk_id_curr, sk_id_bureau, credit_active, credit_currency,
      {_date('days_credit', 'credit_date')}, credit_day_overdue,
      {_date('days_credit_enddate', 'enddate_date')}, {_date('days_enddate_fact', 'close_date')},
      amt_credit_max_overdue, cnt_credit_prolong, amt_credit_sum, amt_credit_sum_debt,
      amt_credit_sum_limit, amt_credit_sum_overdue, credit_type,
      {_date('days_credit_update', 'update_date')}, amt_annuity FROM bureau""",
    "fact_bureau_balance": """
    SELECT sk_id_bureau,
      CAST(ingest_date + to_months(months_balance) AS DATE) AS balance_date,
      status AS status_code,
      CASE status WHEN 'C' THEN 'closed' WHEN 'X' THEN 'unknown' WHEN '0' THEN 'no_DPD'
        WHEN '1' THEN 'DPD_1_30' WHEN '2' THEN 'DPD_31_60' WHEN '3' THEN 'DPD_61_90'
        WHEN '4' THEN 'DPD_91_120' WHEN '5' THEN 'DPD_120_plus' ELSE 'other' END AS status_desc
    FROM bureau_balance""",
    "fact_previous_application": f"""
    SELECT sk_id_curr, sk_id_prev, {KEY} AS application_date_id, name_contract_type, amt_annuity,
      amt_application, amt_credit, amt_down_payment, amt_goods_price, weekday_appr_process_start,
      hour_appr_process_start,
      CAST(CASE WHEN flag_last_appl_per_contract = 'Y' THEN 1 ELSE 0 END AS INT)
        AS flag_last_appl_per_contract,
      CAST(CASE WHEN nflag_last_appl_in_day = 1 THEN 1 ELSE 0 END AS INT)
        AS nflag_last_appl_in_day,
      rate_down_payment, rate_interest_primary, rate_interest_privileged,
      name_cash_loan_purpose, name_contract_status, {_date('days_decision', 'decision_date')},
      name_payment_type, code_reject_reason, name_type_suite, name_client_type,
      name_goods_category, name_portfolio, name_product_type, channel_type, sellerplace_area,
      name_seller_industry, cnt_payment, name_yield_group, product_combination,
      {_date('days_first_drawing', 'first_drawing_date')},
      {_date('days_first_due', 'first_due_date')},
      {_date('days_last_due_1st_version', 'last_due_1st_date')},
      {_date('days_last_due', 'last_due_date')}, {_date('days_termination', 'termination_date')},
      CAST(CASE WHEN nflag_insured_on_approval = 1 THEN 1 ELSE 0 END AS INT)
        AS nflag_insured_on_approval FROM previous""",
    "fact_pos_cash_balance": """
    SELECT sk_id_curr, sk_id_prev, months_balance, cnt_instalment, cnt_instalment_future,
      name_contract_status, sk_dpd, sk_dpd_def FROM pos""",
    "fact_credit_card_balance": "SELECT * FROM card",
    "fact_installments_payments": """
    SELECT sk_id_curr, sk_id_prev, num_instalment_version, num_instalment_number,
      days_instalment, days_entry_payment, amt_instalment, amt_payment FROM instalments""",
}
