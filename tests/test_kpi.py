"""Pre-aggregated figures against plain row joins, with keys that repeat on both sides."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import kpi, star
from tables import rows

DATED = ["sk_id_curr", "application_date_id"]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(11)
    day = lambda: 20240100 + rnd.choice([1, 2, 15])
    client = lambda: 1 if rnd.random() < 0.4 else rnd.randrange(2, 9)
    make = spark.createDataFrame
    n = 120
    return {
        "fact": make([(client(), day(), rnd.randrange(2)) for _ in range(n)],
                     "sk_id_curr int, application_date_id int, target int"),
        "contract": make(
            [(client(), day(), rnd.choice(["Cash", "Card"]), rnd.choice([None, 100.0, 250.0]),
              rnd.choice([0.0, 10.0, None]), rnd.choice([None, 0.5])) for _ in range(40)],
            "sk_id_curr int, application_date_id int, name_contract_type string, amt_credit double,"
            " amt_annuity double, credit_income_ratio double").distinct(),
        "client": make([(c, "abc"[c % 3], float(c % 2), "xy"[c % 2]) for c in range(1, 9)] + [(1, "z", 9.0, None)],
                       "sk_id_curr int, name_income_type string, region_population_relative double,"
                       " name_family_status string"),
        "job": make([(client(), day(), rnd.choice(["cook", None])) for _ in range(30)],
                    "sk_id_curr int, application_date_id int, occupation_type string"),
        "score": make([(client(), day(), rnd.choice([0.25, 0.5, None])) for _ in range(30)],
                      "sk_id_curr int, application_date_id int, ext_source_mean double"),
        "requests": make([(client(), day(), 1, 2, None, 4, 5, rnd.randrange(3)) for _ in range(30)],
                         "sk_id_curr int, application_date_id int, " + ", ".join(
                             f"{c} int" for c in star.REQUEST_COUNTS)),
        "card": make([(client(), rnd.randrange(3), rnd.choice([0, 5, None]), -rnd.randrange(4),
                       float(rnd.randrange(100)), rnd.choice([0.0, 50.0])) for _ in range(n)],
                     "sk_id_curr int, sk_id_prev int, sk_dpd int, months_balance int,"
                     " amt_balance double, amt_credit_limit_actual double"),
        "previous": make([(client(), rnd.randrange(3), day()) for _ in range(30)],
                         "sk_id_curr int, sk_id_prev int, application_date_id int"),
        "paid": make([(client(), rnd.randrange(3), rnd.randrange(-50, 120), rnd.randrange(-50, 50))
                      for _ in range(n)],
                     "sk_id_curr int, sk_id_prev int, days_instalment int, days_entry_payment int"),
        "bureau": make([(client(), rnd.choice([None, 1, 2])) for _ in range(n)],
                       "sk_id_curr int, cnt_credit_prolong int"),
        "dates": make([(20240101, dt.date(2024, 1, 1), 2024, 1), (20240102, dt.date(2024, 1, 2), 2024, 1),
                       (20240115, dt.date(2024, 1, 15), 2024, 1)],
                      "date_id int, application_date date, year int, month int"),
    }


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    left, right = rows(a.select(*b.columns)), rows(b)
    assert len(left) == len(right) and left
    for x, y in zip(left, right):
        for c in b.columns:
            assert x[c] == pytest.approx(y[c]), (c, x, y)


def share(cond):
    return F.try_divide(F.sum(F.when(cond, 1).otherwise(0)), F.count("*"))


def test_origination(tables):
    t = tables
    joined = t["fact"].join(t["contract"], DATED)
    same(kpi.origination_count(t["fact"], t["dates"], t["contract"]),
         joined.join(t["dates"], F.col("application_date_id") == F.col("date_id")).groupBy(
             F.date_format("application_date", "yyyy-MM").alias("month_year"),
             F.col("name_contract_type").alias("contract_type"),
         ).agg(F.count("*").alias("num_applications")))
    same(kpi.origination_sum(t["fact"], t["contract"], t["client"], t["job"]),
         joined.join(t["client"], "sk_id_curr").join(t["job"], DATED).groupBy(
             F.col("region_population_relative").alias("region"), F.col("occupation_type").alias("occupation"),
         ).agg(F.sum("amt_credit").alias("total_disbursed")))
    same(kpi.origination_avg(t["fact"], t["contract"], t["client"]),
         joined.join(t["client"], "sk_id_curr").groupBy(F.col("name_income_type").alias("income_type")).agg(
             F.avg("amt_credit").alias("avg_loan_amount")))
    same(kpi.origination_approval_rate(t["fact"], t["score"], t["requests"]),
         t["fact"].join(t["score"], DATED).join(t["requests"], DATED).groupBy(
             "ext_source_mean", F.col(star.REQUEST_COUNTS[-1]).alias("cb_requests_year"),
         ).agg(share(F.col("target") == 0).alias("approval_rate")))
    same(kpi.default_rate(t["fact"], t["contract"]),
         joined.groupBy(F.col("name_contract_type").alias("contract_type")).agg(
             share(F.col("target") == 1).alias("default_rate")))


def test_portfolio(tables):
    t = tables
    same(kpi.utilization_ratio(t["card"], t["client"]),
         t["card"].join(t["client"], "sk_id_curr").groupBy(F.col("name_income_type").alias("client_segment")).agg(
             F.try_divide(F.sum("amt_balance"), F.sum("amt_credit_limit_actual")).alias("utilization_ratio")))
    same(kpi.overdue_ratio(t["card"], t["previous"], t["contract"]),
         t["card"].join(t["previous"], ["sk_id_curr", "sk_id_prev"]).join(t["contract"], DATED).groupBy(
             F.col("name_contract_type").alias("contract_type")).agg(share(F.col("sk_dpd") > 0).alias("overdue_ratio")))


def test_delinquency(tables):
    t = tables
    bridged = t["paid"].join(t["previous"], ["sk_id_curr", "sk_id_prev"])
    same(kpi.avg_days_past_due(t["paid"], t["previous"], t["job"]),
         bridged.where("days_entry_payment > 0").join(t["job"], DATED).groupBy(
             F.col("occupation_type").alias("occupation")).agg(F.avg("days_entry_payment").alias("avg_days_past_due")))
    same(kpi.time_to_first_default(t["paid"], t["previous"], t["score"]),
         bridged.where("days_instalment > 0").join(t["score"], DATED).groupBy("ext_source_mean").agg(
             F.min("days_instalment").alias("time_to_first_default")))
    status = t["paid"].join(t["client"], "sk_id_curr").where("name_family_status is not null").groupBy(
        F.col("name_family_status").alias("family_status"))
    same(kpi.delinquency_rate(kpi.delinquency_rates(t["paid"], t["client"]), 60),
         status.agg(share(F.col("days_instalment") > 60).alias("delinq_60")))


def test_bound_nobody_exceeds_gives_no_rows(tables):
    rates = kpi.delinquency_rates(tables["paid"], tables["client"], bounds=(100000,))
    assert kpi.delinquency_rate(rates, 100000).count() == 0


def test_bureau(tables):
    t = tables
    same(kpi.prolongations_by_requests(t["bureau"], t["requests"]),
         t["bureau"].join(t["requests"], "sk_id_curr").groupBy(
             F.col(star.REQUEST_COUNTS[-1]).alias("cb_requests_year")).agg(
                 F.sum("cnt_credit_prolong").alias("total_credit_prolong")))
    # One request count is never known, so the total is not known either.
    got = kpi.requests_by_month(t["requests"]).collect()
    assert [(r["month_year"], r["total_cb_requests"]) for r in got] == [("202401", None)]
