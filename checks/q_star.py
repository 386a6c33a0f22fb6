"""Dimensions, facts and figures."""

from checks.registry import query
from checks.star_sql import half_up
from ledgerloom.plans import kpi

IDS = {
    "dim_date": "dim1", "dim_client": "dim2", "dim_contract": "dim3", "dim_employment": "dim4",
    "dim_ext_source": "dim5", "dim_document_flags": "dim6", "dim_cb_requests": "dim7",
    "fact_application": "fct1", "fact_bureau": "fct2", "fact_bureau_balance": "fct3",
    "fact_previous_application": "fct4", "fact_pos_cash_balance": "fct5",
    "fact_credit_card_balance": "fct6", "fact_installments_payments": "fct7",
}

for _name, _id in IDS.items():
    query(f"{_id}_{_name}", f"SELECT * FROM {_name}")(lambda d, n=_name: d.star(n)[0])

DATED = "USING (sk_id_curr, application_date_id)"


def _share(cond):
    return f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*)"


KPI_SQL = {
    "gld1_contract_summary": ("contract_summary", f"""
        SELECT strftime(make_date(year, month, 1), '%Y-%m') AS month_year, name_contract_type,
          count(sk_id_curr) AS cnt_contracts, round(sum(amt_credit), 2) AS sum_credit,
          {half_up('avg(credit_income_ratio)', 4, 9)} AS avg_credit_income_ratio,
          {half_up('avg(amt_credit / nullif(amt_annuity, 0))', 2, 7)} AS avg_term_months
        FROM dim_contract LEFT JOIN dim_date ON application_date_id = date_id
        GROUP BY year, month, name_contract_type"""),
    "gld2_origination_count": ("origination_count", f"""
        SELECT strftime(application_date, '%Y-%m') AS month_year,
          name_contract_type AS contract_type, count(*) AS num_applications
        FROM fact_application JOIN dim_date ON application_date_id = date_id
        JOIN dim_contract {DATED} GROUP BY ALL"""),
    "gld3_origination_sum": ("origination_sum", f"""
        SELECT region_population_relative AS region, occupation_type AS occupation,
          sum(amt_credit) AS total_disbursed
        FROM fact_application JOIN dim_contract {DATED} JOIN dim_client USING (sk_id_curr)
        JOIN dim_employment {DATED} GROUP BY ALL"""),
    "gld4_origination_avg": ("origination_avg", f"""
        SELECT name_income_type AS income_type, avg(amt_credit) AS avg_loan_amount
        FROM fact_application JOIN dim_contract {DATED} JOIN dim_client USING (sk_id_curr)
        GROUP BY ALL"""),
    "gld5_origination_approval_rate": ("origination_approval_rate", f"""
        SELECT ext_source_mean, amt_req_credit_bureau_year AS cb_requests_year,
          {_share('target = 0')} AS approval_rate
        FROM fact_application JOIN dim_ext_source {DATED} JOIN dim_cb_requests {DATED}
        GROUP BY ALL"""),
    "gld6_total_active_balance": ("portfolio_total_active_balance", """
        WITH c AS (SELECT sk_id_curr, sum(amt_balance) AS b FROM fact_credit_card_balance GROUP BY 1),
        p AS (SELECT sk_id_curr, sum(cnt_instalment) AS b FROM fact_pos_cash_balance GROUP BY 1),
        t AS (SELECT coalesce(c.sk_id_curr, p.sk_id_curr) AS sk_id_curr,
                coalesce(c.b, 0) + coalesce(CAST(p.b AS DOUBLE), 0) AS b
              FROM c FULL JOIN p ON c.sk_id_curr = p.sk_id_curr)
        SELECT region_population_relative AS region, sum(b) AS total_active_balance
        FROM t JOIN dim_client USING (sk_id_curr) GROUP BY 1"""),
    "gld7_utilization_ratio": ("portfolio_utilization_ratio", """
        SELECT name_income_type AS client_segment,
          sum(amt_balance) / nullif(sum(amt_credit_limit_actual), 0) AS utilization_ratio
        FROM fact_credit_card_balance JOIN dim_client USING (sk_id_curr) GROUP BY 1"""),
    "gld8_overdue_balance": ("portfolio_overdue_balance", """
        SELECT months_balance AS month_offset, sum(amt_balance) AS overdue_balance
        FROM fact_credit_card_balance WHERE sk_dpd > 0 GROUP BY 1"""),
    "gld9_overdue_ratio": ("portfolio_overdue_ratio", f"""
        SELECT c.name_contract_type AS contract_type, {_share('sk_dpd > 0')} AS overdue_ratio
        FROM fact_credit_card_balance
        JOIN (SELECT sk_id_curr, sk_id_prev, application_date_id FROM fact_previous_application)
          USING (sk_id_curr, sk_id_prev)
        JOIN dim_contract c {DATED} GROUP BY 1"""),
    "gld10_default_rate": ("delinquency_default_default_rate", f"""
        SELECT name_contract_type AS contract_type, {_share('target = 1')} AS default_rate
        FROM fact_application JOIN dim_contract {DATED} GROUP BY 1"""),
    "gld12_avg_days_past_due": ("delinquency_avg_days_past_due", f"""
        SELECT occupation_type AS occupation, avg(days_entry_payment) AS avg_days_past_due
        FROM (SELECT * FROM fact_installments_payments WHERE days_entry_payment > 0)
        JOIN (SELECT sk_id_curr, sk_id_prev, application_date_id FROM fact_previous_application)
          USING (sk_id_curr, sk_id_prev)
        JOIN dim_employment {DATED} GROUP BY 1"""),
    "gld13_time_to_first_default": ("delinquency_time_to_first_default", f"""
        SELECT ext_source_mean, min(days_instalment) AS time_to_first_default
        FROM (SELECT * FROM fact_installments_payments WHERE days_instalment > 0)
        JOIN (SELECT sk_id_curr, sk_id_prev, application_date_id FROM fact_previous_application)
          USING (sk_id_curr, sk_id_prev)
        JOIN dim_ext_source {DATED} GROUP BY 1"""),
    "gld14_old_loans_count": ("cb_old_loans_count", """
        SELECT region_population_relative AS region, count(*) AS old_loans_count
        FROM fact_bureau JOIN dim_client USING (sk_id_curr) GROUP BY 1"""),
    "gld15_old_credit_by_year": ("cb_old_credit_sum_by_year", """
        SELECT CAST(year(credit_date) AS INT) AS year, sum(amt_credit_sum) AS old_credit_sum
        FROM fact_bureau GROUP BY 1"""),
    "gld16_prolongations_by_requests": ("cb_credit_prolong_by_requests_year", """
        SELECT amt_req_credit_bureau_year AS cb_requests_year,
          CAST(sum(cnt_credit_prolong) AS BIGINT) AS total_credit_prolong
        FROM fact_bureau JOIN dim_cb_requests USING (sk_id_curr) GROUP BY 1"""),
    "gld17_requests_by_month": ("cb_total_requests_by_month", """
        SELECT substr(CAST(application_date_id AS VARCHAR), 1, 6) AS month_year,
          CAST(sum(amt_req_credit_bureau_hour) + sum(amt_req_credit_bureau_day)
            + sum(amt_req_credit_bureau_week) + sum(amt_req_credit_bureau_mon)
            + sum(amt_req_credit_bureau_qrt) + sum(amt_req_credit_bureau_year) AS BIGINT)
          AS total_cb_requests
        FROM dim_cb_requests GROUP BY 1"""),
}

for _key, (_table, _sql) in KPI_SQL.items():
    def _run(d, t=_table):
        build, inputs = kpi.INPUTS[t]
        return build(*d.star(*inputs))

    query(_key, _sql)(_run)

for _bound in kpi.DELINQUENCY_BOUNDS:
    query(f"gld11_delinquency_rate_{_bound}", f"""
        WITH i AS (SELECT name_family_status AS family_status, days_instalment
            FROM fact_installments_payments JOIN dim_client USING (sk_id_curr)),
        a AS (SELECT family_status, count(*) AS n FROM i GROUP BY 1),
        o AS (SELECT family_status, count(*) AS n FROM i WHERE days_instalment > {_bound} GROUP BY 1)
        SELECT family_status, CAST(o.n AS DOUBLE) / a.n AS delinq_{_bound}
        FROM o JOIN a USING (family_status)""")(
        lambda d, b=_bound: kpi.delinquency_rate(
            kpi.delinquency_rates(*d.star("fact_installments_payments", "dim_client")), b
        )
    )
