"""The given tables in the role of credit tables.

The operators read credit data; the given tables are orders, line items,
customers and events.  Each role is one projection of whole tables, written once
and rendered for Spark and for the checking engine, which differ only in how
they subtract dates.  Amounts are whole numbers, so that sums do not depend on
the order of addition.  Some values are turned into NULL, zero or a sentinel.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import written

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"]
TODAY = "DATE '2001-08-01'"
EVENT_TODAY = "DATE '2024-01-31'"


def _whole(x: str) -> str:
    return f"CAST(floor({x}) AS DOUBLE)"


def _int(x: str) -> str:
    return f"CAST({x} AS INT)"


class _Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def t(self, table: str) -> str:
        return f"{{{table}}}" if self.spark else table

    def days(self, day: str, since: str = TODAY) -> str:
        """Days from ``since`` to ``day`` (negative in the past)."""
        if self.spark:
            return f"datediff(CAST({day} AS DATE), {since})"
        return f"CAST(CAST({day} AS DATE) - {since} AS INT)"

    def months(self, day: str, since: str = TODAY) -> str:
        return _int(f"floor(CAST({self.days(day, since)} AS DOUBLE) / 30)")


def _application(d: _Dialect, k: str, price: str, day: str, bad: str, kind: str, source: str) -> str:
    c = "c_custkey"
    documents = ", ".join(
        f"{_int(f'CASE WHEN ({k} + {i}) % {i + 3} = 0 THEN 1 ELSE 0 END')} AS flag_document_{i}"
        for i in range(2, 22)
    )
    requests = ", ".join(
        f"{_int(f'CASE WHEN {k} % {10 + n} = 0 THEN NULL ELSE {k} % {n} END')} "
        f"AS amt_req_credit_bureau_{period}"
        for period, n in zip(("hour", "day", "week", "mon", "qrt", "year"), (2, 3, 4, 5, 6, 7))
    )
    return f"""
    SELECT {c} AS sk_id_curr,
      {_int(f"CASE WHEN {bad} THEN 1 ELSE 0 END")} AS target,
      {kind} AS name_contract_type,
      nullif(c_mktsegment, 'MACHINERY') AS name_type_suite,
      c_mktsegment AS name_income_type,
      'Education ' || CAST({k} % 5 AS STRING) AS name_education_type,
      CASE n_name WHEN 'NATION_3' THEN 'Unknown' WHEN 'NATION_7' THEN NULL ELSE n_name END
        AS name_family_status,
      nullif(r_name, 'ASIA') AS name_housing_type,
      CASE WHEN {k} % 7 = 0 THEN NULL ELSE 'Job / ' || CAST({k} % 7 AS STRING) END
        AS occupation_type,
      'Org: ' || CAST(c_nationkey % 12 AS STRING) AS organization_type,
      'DAY ' || CAST({k} % 7 AS STRING) AS weekday_appr_process_start,
      CASE WHEN {c} % 10 < 5 THEN 'F' WHEN {c} % 10 < 9 THEN 'M' ELSE 'XNA' END AS code_gender,
      CASE WHEN {c} % 3 = 0 THEN 'Y' ELSE 'N' END AS flag_own_car,
      CASE WHEN {c} % 5 < 3 THEN 'Y' ELSE 'N' END AS flag_own_realty,
      {_int(f"nullif({c} % 17, 0) * 0 + 1")} AS flag_mobil,
      {_int(f"{c} % 2")} AS flag_emp_phone,
      {_int("1")} AS flag_cont_mobile,
      {_int(f"{c} % 7 % 2")} AS flag_email,
      {documents},
      {_int(f"{c} % 4")} AS cnt_children,
      {_int(f"CASE WHEN {c} % 11 = 0 THEN NULL ELSE {c} % 4 + 1 END")} AS cnt_fam_members,
      CAST(c_nationkey + 1 AS DOUBLE) / 64 AS region_population_relative,
      {_int("n_regionkey % 3 + 1")} AS region_rating_client,
      {_int("n_regionkey % 2 + 1")} AS region_rating_client_w_city,
      {_whole("c_acctbal + 1000")} * 10 AS amt_income_total,
      {_whole(price)} AS amt_credit,
      CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 17 = 0 THEN CAST(0 AS DOUBLE)
        ELSE {_whole(f"{price} / (12 + {k} % 24)")} END AS amt_annuity,
      CASE WHEN {k} % 19 = 0 THEN NULL ELSE {_whole(f"{price} * 7 / 8")} END AS amt_goods_price,
      CASE WHEN {k} % 6 = 0 THEN NULL ELSE CAST({k} % 64 AS DOUBLE) / 64 END AS ext_source_1,
      CASE WHEN {c} % 9 = 0 THEN NULL ELSE CAST({c} % 32 AS DOUBLE) / 32 END AS ext_source_2,
      CAST(({k} + {c}) % 16 AS DOUBLE) / 16 AS ext_source_3,
      CASE WHEN {c} % 3 = 0 THEN CAST({c} % 25 AS DOUBLE) ELSE NULL END AS own_car_age,
      {_int(f"-(7000 + {c} * 37 % 18000)")} AS days_birth,
      {_int(f"CASE WHEN {k} % 8 = 0 THEN 365243 ELSE -({k} * 13 % 9000) END")} AS days_employed,
      {_int(f"-({k} * 7 % 12000)")} AS days_registration,
      {_int(f"-({k} * 5 % 6000)")} AS days_id_publish,
      CAST(-({k} * 3 % 4000) AS DOUBLE) AS days_last_phone_change,
      {requests},
      {day} AS ingest_date
    FROM {source}"""


@cache
def role_sql(spark: bool) -> dict[str, str]:
    d = _Dialect(spark)
    client = f"""{d.t('customer')} JOIN {d.t('nation')} ON c_nationkey = n_nationkey
      JOIN {d.t('region')} ON n_regionkey = r_regionkey"""
    k = "o_orderkey"
    since = d.days("o_orderdate")
    due = d.days("l_shipdate")
    month = d.months("l_shipdate")
    paid_after = """CASE WHEN l_partkey % 10 = 0 THEN CAST(l_suppkey * 7 % 800 AS INT)
        ELSE CAST(l_partkey % 60 - 40 AS INT) END"""
    ship = f"{d.t('lineitem')} JOIN {d.t('orders')} ON l_orderkey = o_orderkey"
    money = _whole("l_extendedprice / 1024")
    return {
        # One application per order; a client applies on many dates.
        "application": _application(
            d, k, "o_totalprice", "CAST(o_orderdate AS DATE)", "o_orderstatus = 'F'",
            "o_orderpriority",
            f"""{d.t('orders')} JOIN {d.t('customer')} ON o_custkey = c_custkey
      JOIN {d.t('nation')} ON c_nationkey = n_nationkey
      JOIN {d.t('region')} ON n_regionkey = r_regionkey""",
        ),
        # One application per client.
        "applicant": _application(
            d, "c_custkey", "(c_acctbal + 1000) * 17", TODAY, "c_custkey % 4 = 0",
            "CASE WHEN c_custkey % 6 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END", client,
        ),
        # New applicants, for what was learned on others: some of their categories are unknown there.
        "newcomer": _application(
            d, "c_custkey", "(c_acctbal + 2000) * 9", TODAY, "c_custkey % 7 = 0",
            "CASE WHEN c_custkey % 5 = 0 THEN 'Micro loans' ELSE 'Cash loans' END",
            f"""(SELECT s_suppkey AS c_custkey, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
        CASE s_suppkey % 4 WHEN 0 THEN 'SPACE' WHEN 1 THEN 'BUILDING' ELSE 'HOUSEHOLD' END AS c_mktsegment
      FROM {d.t('supplier')}) JOIN {d.t('nation')} ON c_nationkey = n_nationkey
      JOIN {d.t('region')} ON n_regionkey = r_regionkey""",
        ),
        "bureau": f"""
    SELECT o_custkey AS sk_id_curr, {k} AS sk_id_bureau,
      CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END
        AS credit_active,
      CASE WHEN {k} % 9 = 0 THEN 'currency 2' ELSE 'currency 1' END AS credit_currency,
      o_orderpriority AS credit_type,
      {since} AS days_credit,
      CASE WHEN {k} % 7 = 0 THEN NULL ELSE CAST({since} + {k} % 1500 AS DOUBLE) END
        AS days_credit_enddate,
      CASE WHEN o_orderstatus = 'F' THEN CAST({since} + {k} % 900 AS DOUBLE) ELSE NULL END
        AS days_enddate_fact,
      {_int(f"-({k} % 400)")} AS days_credit_update,
      {_int(f"CASE WHEN {k} % 50 = 0 THEN {k} % 300 ELSE 0 END")} AS credit_day_overdue,
      {_int(f"{k} % 4")} AS cnt_credit_prolong,
      CASE WHEN {k} % 3 = 0 THEN NULL ELSE {_whole("o_totalprice / 100")} END
        AS amt_credit_max_overdue,
      CASE WHEN {k} % 31 = 0 THEN NULL ELSE {_whole("o_totalprice")} END AS amt_credit_sum,
      CASE WHEN {k} % 5 = 0 THEN NULL WHEN {k} % 5 = 1 THEN CAST(0 AS DOUBLE)
        ELSE {_whole("o_totalprice / 3")} END AS amt_credit_sum_debt,
      CASE WHEN {k} % 4 = 0 THEN NULL ELSE {_whole("o_totalprice / 7")} END
        AS amt_credit_sum_limit,
      {_whole(f"o_totalprice / 1000 * ({k} % 2)")} AS amt_credit_sum_overdue,
      CASE WHEN {k} % 6 = 0 THEN NULL WHEN {k} % 6 = 1 THEN CAST(0 AS DOUBLE)
        ELSE {_whole("o_totalprice / 24")} END AS amt_annuity,
      {TODAY} AS ingest_date
    FROM {d.t('orders')}""",
        "bureau_balance": f"""
    SELECT l_orderkey AS sk_id_bureau,
      {_int(f"floor(CAST({due} AS DOUBLE) / 30) - 4")} AS months_balance,
      CASE l_returnflag WHEN 'A' THEN 'C' WHEN 'N' THEN 'X'
        ELSE CAST(l_linenumber % 7 AS STRING) END AS status,
      DATE '2001-07-31' AS ingest_date
    FROM {d.t('lineitem')}""",
        "previous": f"""
    SELECT o_custkey AS sk_id_curr, {k} AS sk_id_prev,
      CASE WHEN {k} % 3 = 0 THEN 'Cash loans' ELSE 'Consumer loans' END AS name_contract_type,
      'DAY ' || CAST({k} % 7 AS STRING) AS weekday_appr_process_start,
      CASE WHEN {k} % 4 = 0 THEN 'N' ELSE 'Y' END AS flag_last_appl_per_contract,
      'Purpose ' || CAST({k} % 4 AS STRING) AS name_cash_loan_purpose,
      CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END
        AS name_contract_status,
      'Cash' AS name_payment_type,
      CASE WHEN o_orderstatus = 'O' THEN 'LIMIT' ELSE 'XAP' END AS code_reject_reason,
      CASE WHEN {k} % 2 = 0 THEN NULL ELSE 'Family' END AS name_type_suite,
      CASE WHEN {k} % 5 = 0 THEN 'New' ELSE 'Repeater' END AS name_client_type,
      o_orderpriority AS name_goods_category,
      'POS' AS name_portfolio,
      CASE WHEN {k} % 6 = 0 THEN 'walk-in' ELSE 'x-sell' END AS name_product_type,
      'Channel ' || CAST({k} % 3 AS STRING) AS channel_type,
      CASE WHEN {k} % 3 = 1 THEN 'Industry' ELSE 'Trade' END AS name_seller_industry,
      CASE WHEN {k} % 4 = 1 THEN 'high' ELSE 'middle' END AS name_yield_group,
      'Cash ' || CAST({k} % 3 AS STRING) AS product_combination,
      CASE WHEN {k} % 14 = 0 THEN NULL ELSE {_whole("o_totalprice / 24")} END AS amt_annuity,
      {_whole("o_totalprice * 9 / 8")} AS amt_application,
      CASE WHEN {k} % 16 = 0 THEN CAST(0 AS DOUBLE) ELSE {_whole("o_totalprice")} END
        AS amt_credit,
      CASE WHEN {k} % 2 = 1 THEN NULL ELSE {_whole("o_totalprice / 10")} END AS amt_down_payment,
      {_whole("o_totalprice * 3 / 4")} AS amt_goods_price,
      CASE WHEN {k} % 2 = 1 THEN NULL ELSE CAST({k} % 32 AS DOUBLE) / 128 END
        AS rate_down_payment,
      CASE WHEN {k} % 20 = 0 THEN CAST({k} % 16 AS DOUBLE) / 64 ELSE NULL END
        AS rate_interest_primary,
      CASE WHEN {k} % 20 = 0 THEN CAST({k} % 8 AS DOUBLE) / 8 ELSE NULL END
        AS rate_interest_privileged,
      {_int(f"{k} % 24")} AS hour_appr_process_start,
      {_int("1")} AS nflag_last_appl_in_day,
      {_int(f"CASE WHEN {k} % 3 = 2 THEN NULL ELSE {k} % 3 END")} AS nflag_insured_on_approval,
      {_int(f"{k} % 100")} AS sellerplace_area,
      {_int(f"CASE WHEN {k} % 22 = 0 THEN NULL ELSE {k} % 5 * 6 END")} AS cnt_payment,
      {since} AS days_decision,
      CASE WHEN {k} % 10 < 8 THEN CAST(365243 AS DOUBLE) ELSE CAST({since} AS DOUBLE) END
        AS days_first_drawing,
      CASE WHEN {k} % 10 = 0 THEN NULL WHEN {k} % 10 = 1 THEN CAST(0 AS DOUBLE)
        WHEN {k} % 10 = 2 THEN CAST(365243 AS DOUBLE) ELSE CAST({since} + 30 AS DOUBLE) END
        AS days_first_due,
      CASE WHEN {k} % 11 = 0 THEN CAST(365243 AS DOUBLE) ELSE CAST({since} + 300 AS DOUBLE) END
        AS days_last_due_1st_version,
      CASE WHEN {k} % 12 < 3 THEN CAST(365243 AS DOUBLE) ELSE CAST({since} + {k} % 365 AS DOUBLE)
        END AS days_last_due,
      CASE WHEN {k} % 12 < 4 THEN CAST(365243 AS DOUBLE) ELSE CAST({since} + {k} % 400 AS DOUBLE)
        END AS days_termination,
      CAST(o_orderdate AS DATE) AS ingest_date
    FROM {d.t('orders')}""",
        "pos": f"""
    SELECT o_custkey AS sk_id_curr, l_orderkey AS sk_id_prev, {month} AS months_balance,
      {_int("CASE WHEN l_partkey % 15 = 0 THEN NULL ELSE floor(l_quantity) - 1 END")}
        AS cnt_instalment,
      {_int("CASE WHEN l_partkey % 21 = 0 THEN NULL ELSE floor(l_quantity / 2) END")}
        AS cnt_instalment_future,
      CASE l_returnflag WHEN 'A' THEN 'Active' WHEN 'N' THEN 'Completed' ELSE 'Signed / new' END
        AS name_contract_status,
      {_int("CASE WHEN l_suppkey % 6 = 0 THEN l_partkey % 45 ELSE 0 END")} AS sk_dpd,
      {_int("CASE WHEN l_suppkey % 12 = 0 THEN l_partkey % 45 ELSE 0 END")} AS sk_dpd_def
    FROM {ship}""",
        "instalments": f"""
    SELECT o_custkey AS sk_id_curr, l_orderkey AS sk_id_prev,
      {_int("l_suppkey % 3")} AS num_instalment_version,
      {_int("l_linenumber")} AS num_instalment_number,
      {due} AS days_instalment,
      CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE {due} + {paid_after} END AS days_entry_payment,
      CASE WHEN l_quantity = 1 THEN CAST(0 AS DOUBLE) ELSE {_whole("l_extendedprice")} END
        AS amt_instalment,
      CASE WHEN l_partkey % 29 = 0 THEN NULL
        ELSE {_whole("l_extendedprice * (1 - l_discount) + l_suppkey % 5")} END AS amt_payment
    FROM {ship}""",
        "card": f"""
    SELECT o_custkey AS sk_id_curr, l_orderkey AS sk_id_prev, {month} AS months_balance,
      {money} AS amt_balance,
      CAST(l_linenumber % 4 * 50 AS DOUBLE) AS amt_credit_limit_actual,
      CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE {_whole("l_quantity * 3")} END
        AS amt_drawings_atm_current,
      {_whole("l_quantity * 4")} AS amt_drawings_current,
      CAST(0 AS DOUBLE) AS amt_drawings_other_current,
      {_whole("l_quantity")} AS amt_drawings_pos_current,
      CASE WHEN l_partkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE {_whole("l_quantity * 2")} END
        AS amt_inst_min_regularity,
      {_whole("l_quantity * 5")} AS amt_payment_current,
      {_whole("l_quantity * 6")} AS amt_payment_total_current,
      {money} AS amt_receivable_principal,
      {money} AS amt_recivable,
      {money} AS amt_total_receivable,
      {_int("l_quantity")} AS cnt_drawings_atm_current,
      {_int("l_quantity + 1")} AS cnt_drawings_current,
      {_int("l_partkey % 2")} AS cnt_drawings_other_current,
      {_int("l_partkey % 3")} AS cnt_drawings_pos_current,
      {_int("CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE l_partkey % 60 END")}
        AS cnt_instalment_mature_cum,
      CASE l_linestatus WHEN 'O' THEN 'Active' ELSE 'Sent proposal' END AS name_contract_status,
      {_int("CASE WHEN l_suppkey % 9 = 0 THEN l_partkey % 40 ELSE 0 END")} AS sk_dpd,
      {_int("0")} AS sk_dpd_def
    FROM {ship}""",
        # Short histories, for windows of days within a month.
        "event": f"""
    SELECT event_id, user_id AS sk_id_curr, event_type, {_whole("value * 100")} AS cents,
      {d.days("ts", EVENT_TODAY)} AS days_event
    FROM {d.t('events')}""",
        "product": f"""
    SELECT p_partkey, p_brand, nullif(p_type, 'SMALL') AS p_type, p_size,
      {_whole("p_retailprice")} AS price, p_name || ',' || p_brand AS tags
    FROM {d.t('part')}""",
    }


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Line items beside their order, which several roles read.
SHIPPED = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"


def role(spark: SparkSession, folder: str, name: str, shipped: DataFrame | None = None) -> DataFrame:
    """A role; ``shipped`` are line items beside their order where these were joined already."""
    text = role_sql(True)[name]
    if shipped is not None:
        text = text.replace(SHIPPED, "{shipped}")
    used = {t: table(spark, folder, t) for t in TABLES if f"{{{t}}}" in text}
    if "{shipped}" in text:
        used["shipped"] = shipped
    return spark.sql(text, **used)


def shipped(spark: SparkSession, folder: str) -> DataFrame:
    """Line items beside the client of their order, written once for all roles that read them."""
    used = {t: table(spark, folder, t) for t in ("lineitem", "orders")}
    return written(spark.sql(f"SELECT o_custkey, {{lineitem}}.* FROM {SHIPPED}", **used), "shipped")


def with_roles(text: str) -> str:
    """Prefix a check query with the roles (and their dimensions) it names."""
    from checks.star_sql import STAR_SQL

    known = role_sql(False) | STAR_SQL
    order = list(known)

    def needed(sql: str) -> set[str]:
        return {n for n in known if re.search(rf"\b{n}\b", sql)}

    found, todo = set(), needed(text)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo |= needed(known[name]) - found
    found -= {n for n in found if re.search(rf"\b{n} AS (MATERIALIZED )?\(", text)}
    parts = [f"{n} AS ({known[n]})" for n in order if n in found]
    if not parts:
        return text
    head, sep, rest = text.strip().partition("WITH ")
    if sep and not head:
        return f"WITH {', '.join(parts)}, {rest}"
    return f"WITH {', '.join(parts)} {text}"
