import random

import pytest
from pyspark.sql import functions as F

from checks.q_features import sources
from checks.registry import Data
from ledgerloom.operators.aggregates import DAY_WINDOWS, Lookbacks
from ledgerloom.plans import application, bureau, instalments, mart, pos, previous
from ledgerloom.sources import Lake
from tables import rows

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return Data(spark, SMALL)


PAID = "sk_id_curr int, sk_id_prev int, num_instalment_version int, num_instalment_number int," \
       " days_instalment int, days_entry_payment int, amt_instalment double, amt_payment double"


def test_late_and_early(spark):
    late = [6, 7, 15, 30, 60, 90, 180, 720]
    df = spark.createDataFrame([(1, 1, 1, i, -1000, -1000 + d, 10.0, 10.0) for i, d in enumerate(late)]
                               + [(1, 1, 1, 99, -1000, -1003, 10.0, 5.0), (1, 1, 1, 100, -10, None, 0.0, 1.0)], PAID)
    out = rows(instalments.late_buckets(instalments.late_ratios(instalments.delays(df))), "num_instalment_number")
    out = {r["num_instalment_number"]: r for r in out}
    flags = ["dpd_7", "dpd_15", "dpd_30", "dpd_60", "dpd_90", "dpd_180", "dpd_wof"]
    assert [sum(out[i][f] for f in flags) for i in range(len(late))] == list(range(8))
    assert (out[99]["dpd"], out[99]["dbd"], out[99]["late_payment"], out[99]["late_payment_ratio"]) == (0, 3, 1, 0.5)
    unknown = out[100]
    assert (unknown["dpd"], unknown["late_payment"], unknown["instalment_payment_ratio"]) == (None, 0, None)


def test_instalment_paid_twice_and_by_two_clients(spark):
    df = spark.createDataFrame([
        (1, 1, 1, 1, -10, -10, 100.0, 60.0), (1, 1, 2, 1, -10, -5, 100.0, 40.0),
        (2, 1, 1, 1, -10, -9, 100.0, 7.0), (2, 9, None, 2, -400, None, 50.0, None),
        (2, None, 1, 2, -40, -40, 50.0, 5.0)], PAID)
    clean = instalments.clean_instalments(df)
    direct = rows(instalments.per_client_rows(instalments.row_features(clean)), "sk_id_curr")
    merged = rows(instalments.per_client(clean), "sk_id_curr")
    for a, b in zip(direct, merged):
        for name, value in a.items():
            assert b[name] == pytest.approx(value), name


def test_payment_totals_count_only_the_window(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, -3, -3, 100.0, 60.0), (1, 1, 1, 1, -300, -300, 100.0, 40.0)], PAID)
    out = instalments.instalment_features(df, Lookbacks("days_instalment", (("", None), ("_week", 7)))).first()
    assert (out["ins_payment_difference_max"], out["ins_payment_difference_max_week"]) == (0.0, 40.0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_of_instalments_with_several_payers(spark):
    """Unknown clients, loans and numbers, and loans of one payer: as one filter per window."""
    rnd = random.Random(4)
    data = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, 1, 2]),
             rnd.choice([-3, -7, -20, -90, -400]), rnd.choice([None, -5, -50]), 100.0, rnd.choice([None, 10.0, 40.0]))
            for _ in range(150)]
    alone = [(k, 10 * k, 1, n, -30 * n, -8, 50.0, 5.0 * n) for k in (1, 5) for n in (0, 1, 1, 4)]
    payer_unknown = [(None, 77, 1, 1, -1, -1, 9.0, 3.0), (6, 77, 1, 1, -20, -1, 9.0, 4.0)]
    for rows_of_loans in ([*data, *alone, *payer_unknown], alone):
        df = spark.createDataFrame(rows_of_loans, PAID)
        got = {r["sk_id_curr"]: r for r in rows(instalments.instalment_features(df))}
        seen = set()
        for suffix, reach in DAY_WINDOWS:
            part = instalments.clean_instalments(df.where(F.lit(True) if reach is None else F.col("days_instalment") >= -reach))
            for want in rows(instalments.per_client(part)):
                seen.add(want["sk_id_curr"])
                for name, value in want.items():
                    if name != "sk_id_curr":
                        assert got[want["sk_id_curr"]][name + suffix] == pytest.approx(value), (want["sk_id_curr"], name, suffix)
        assert seen == set(got)


def test_payments_of_one_payer_a_loan_are_gathered_by_client_alone(spark):
    df = spark.createDataFrame([(k, 10 * k, 1, n, -30 * n, -8, 50.0, 5.0) for k in (1, 5) for n in (1, 2)], PAID)
    table = instalments.gather_instalments(df).table
    assert "hashpartitioning(sk_id_prev" not in _plan(table) and table.count() == 2


def test_loans_and_months_are_gathered_before_they_are_wide(spark):
    """No partial figure crosses the network, and clients are dealt to the tasks asked for."""
    names = [c for c in bureau.LOAN_AGGREGATES if c != "months_balance_size"]
    loans = spark.range(4000).selectExpr(  # No client or loan is a hot one.
        "nullif(id % 1999, 8) AS sk_id_curr", "id AS sk_id_bureau", "elt(id % 2 + 1, 'Closed', 'Active') AS credit_active",
        *[f"CAST(nullif(id % {i + 3}, 0) AS DOUBLE) AS {c}" for i, c in enumerate(names)])
    months = spark.range(9000).selectExpr(
        "nullif(id % 4500, 7) AS sk_id_bureau", "CAST(-(id % 12) AS INT) AS months_balance", "elt(id % 3 + 1, 'C', 'X', '0') AS status")
    categories, statuses, tasks = {"credit_active": ["Active", "Closed"]}, ["0", "C", "X"], spark.sparkContext.defaultParallelism + 5
    known = loans.where("sk_id_curr IS NOT NULL")
    found = bureau.bureau_features(known, months.where("sk_id_bureau IS NOT NULL"), categories, statuses, tasks=tasks)
    plan = _plan(found)
    assert f", {tasks}), REPARTITION_BY_NUM" in plan and "partial_" in plan
    lines = [line.lstrip(" :+-*()0123456789") for line in plan.splitlines()]
    assert not any(a.startswith("Exchange") and "Aggregate" in b and "partial_" in b for a, b in zip(lines, lines[1:]))
    per_loan = months.groupBy("sk_id_bureau").agg(F.count("*").alias("n"), F.avg(F.expr("int(status = 'C')")).alias("closed"))
    want = loans.join(per_loan, "sk_id_bureau", "left").groupBy("sk_id_curr").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bureau_months_balance_size_sum"), F.avg("closed").alias("bureau_status_C_mean_mean"),
        F.max("amt_credit_sum").alias("bureau_amt_credit_sum_max"))
    whole = bureau.bureau_features(loans, months, categories, statuses)
    got = rows(whole.select(*want.columns), "sk_id_curr")
    assert got == [{k: pytest.approx(v) if isinstance(v, float) else v for k, v in r.items()} for r in rows(want, "sk_id_curr")]


def test_line_items_meet_their_orders_once_for_all_roles(spark, data):
    names = ["pos", "instalments", "card", "bureau"]
    for name, role in zip(names, data.roles(*names)):
        assert "Join" not in _plan(role) and role.schema == data.role(name).schema
        assert role.exceptAll(data.role(name)).isEmpty() and data.role(name).exceptAll(role).isEmpty()


def test_pos_loans(spark):
    data = [(1, 1, -3, 12, 9, "Active"), (1, 1, -1, 10, 4, "Completed"), (1, 1, -2, 11, 6, "Active"),
            (1, 2, -1, None, 5, "Active"), (1, 2, -2, 0, 3, "Active"), (1, 3, -1, 6, 1, "Completed")]
    df = spark.createDataFrame(data, "sk_id_curr int, sk_id_prev int, months_balance int, cnt_instalment int,"
                                     " cnt_instalment_future int, name_contract_status string")
    loans = {r["sk_id_prev"]: r for r in rows(pos.per_loan(df), "sk_id_prev")}
    assert [loans[i]["pos_completed_before_mean"] for i in (1, 2, 3)] == [1, 0, 0]
    assert [loans[i]["pos_remaining_instalments"] for i in (1, 2, 3)] == [4, 5, 1]
    assert loans[1]["pos_remaining_instalments_ratio"] == 0.4
    assert loans[2]["pos_remaining_instalments_ratio"] is None
    total = pos.loans_per_client(df).first()
    assert total["pos_remaining_instalments"] == 10


def test_previous_markers(spark):
    names = previous.MARKED_DAYS
    schema = "id int, " + ", ".join(f"{c} double" for c in names)
    df = spark.createDataFrame([(1, *[365243.0] * 5), (2, *[0.0] * 5), (3, *[-9.0] * 5)], schema)
    out = rows(previous.clean_previous(df), "id")
    assert [out[0][c] for c in names] == [None] * 5
    assert [out[1][c] for c in names] == [0.0, None, None, None, None]
    assert [out[2][c] for c in names] == [-9.0] * 5


def test_encoder_gives_train_and_test_the_same_columns(data):
    train = application.clean_application(data.role("applicant"))
    test = application.clean_application(
        data.role("applicant").where("name_housing_type is not null").withColumn(
            "name_income_type", F.lit("Never seen")))
    encoder = application.ApplicationEncoder.fit(train)
    a, b = encoder.apply(train), encoder.apply(test)
    assert a.columns == b.columns
    seen = [c for c in a.columns if c.startswith("name_income_type_")]
    assert set(tuple(r) for r in b.select(*seen).collect()) == {(0,) * len(seen)}


def test_mart_has_one_row_per_applicant_and_unique_columns(data):
    cleaned = application.clean_application(data.role("applicant"))
    fitted = mart.MartEncoder.fit(cleaned, sources(data))
    out = mart.feature_mart(cleaned, sources(data), fitted)
    assert len({c.lower() for c in out.columns}) == len(out.columns) > 2000
    ids = out.select("sk_id_curr").collect()
    assert len(ids) == len(set(ids)) == data.table("customer").count()


def test_encoder_is_kept_and_loaded_without_the_data(data, spark, tmp_path):
    """Versions stay; a loaded encoder gives what the fitted one gives, and reads no training table."""
    lake = Lake(spark, str(tmp_path / "lake"))
    cleaned = application.clean_application(data.role("applicant"))
    with pytest.raises(KeyError):
        mart.MartEncoder.load(lake, "mart")
    assert mart.MartEncoder.fit_and_save(lake, "mart", cleaned, sources(data)) == 1
    few = cleaned.where("name_contract_type = 'Cash loans'")
    assert mart.MartEncoder.fit_and_save(lake, "mart", few, sources(data), limits={"organization_type": 3}) == 2
    old, new = (mart.MartEncoder.load(Lake(spark, str(tmp_path / "lake")), "mart", v) for v in (1, None))
    assert len(old.application.categories["name_contract_type"]) == 2
    assert new.application.categories["name_contract_type"] == ["Cash loans"]
    assert new.application.wide == ("organization_type",) and "organization_type" not in new.application.categories
    fitted = mart.MartEncoder.fit(cleaned, sources(data))
    for a, b in ((fitted.application.apply(cleaned), old.application.apply(cleaned)),):
        assert a.columns == b.columns and rows(a, "sk_id_curr") == rows(b, "sk_id_curr")
    spine = application.clean_application(data.role("newcomer"))
    files = old.application.apply(spine).inputFiles()
    assert not any("customer.parquet" in f for f in files) and any("/learned/mart/1/" in f for f in files)
    assert new.application.wide_values(cleaned).where("name = 'organization_type'").count() == cleaned.count()
    assert "organization_type" not in new.application.apply(cleaned).columns


def test_figures_of_few_clients_equal_those_among_all(spark, monkeypatch):
    """Details of other clients are left out, but not their payments on a shared instalment."""
    kind = ("sk_id_curr int, sk_id_prev int, num_instalment_version int, num_instalment_number int, days_instalment int, "
            "days_entry_payment int, amt_instalment double, amt_payment double")
    paid = [(k, k % 3, 1, n, -5 * n, -5 * n + k % 4, 100.0 * n, 30.0 * k) for k in (1, 2, 3, 4, 7) for n in (1, 2, 9)]
    df = spark.createDataFrame([*paid, (None, 1, 1, 1, -5, -4, 100.0, 11.0)], kind)
    ids = spark.createDataFrame([(1,), (4,), (4,), (99,), (None,)], "sk_id_curr int")
    asked = mart.details_of(ids)
    assert asked(df).columns == df.columns and asked(df).count() == 6
    part = instalments.gather_instalments(df, asked=asked).unfold()
    whole = instalments.instalment_features(df).where("sk_id_curr IN (1, 4)")
    assert rows(part, "sk_id_curr") == rows(whole, "sk_id_curr") and part.count() == 2
    monkeypatch.setattr(mart, "FEW", 2)
    assert mart.details_of(ids)(df) is df
