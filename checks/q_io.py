"""Sources, sinks, catalog, ingest and the layers end to end.

Each query writes a table to the scratch folder and returns what is read back.
"""

import datetime as dt
import uuid
from functools import partial

from pyspark.sql import functions as F

from checks.registry import query
from ledgerloom.operators.columns import align_columns
from ledgerloom.plans.layers import run_layers
from ledgerloom.session import at_once
from ledgerloom.sources import (
    Lake,
    export_csv,
    export_scores,
    ingest_table,
    ingest_tables,
    read_csv,
    read_csv_head,
    scratch_folder,
    stamp_ingest,
)

DAY_ONE, DAY_TWO = dt.date(2001, 8, 1), dt.date(2001, 8, 2)


def _csv(d, df, name):
    path = scratch_folder(d.spark, name)
    export_csv(df, path)
    return path


def _lake(d, name):
    return Lake(d.spark, scratch_folder(d.spark, name))


@query("src1_csv_scan", """SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey,
    c_acctbal, c_mktsegment FROM customer""")
def _src1(d):
    return read_csv(d.spark, _csv(d, d.table("customer"), "src1"))


@query("src2_table_scan", "SELECT * FROM supplier")
def _src2(d):
    lake = _lake(d, "src2")
    lake.replace(d.table("supplier"), "supplier")
    return lake.read("supplier")


@query("src3_csv_head", """SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey,
    c_acctbal, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 20""")
def _src3(d):
    path = scratch_folder(d.spark, "src3")
    # One sorted file, so that its first rows are known.
    export_csv(d.table("customer").orderBy("c_custkey").coalesce(1), path)
    return read_csv_head(d.spark, path, 20)


@query("src4_csv_with_schema", "SELECT * FROM instalments")
def _src4(d):
    df = d.role("instalments")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return read_csv(d.spark, _csv(d, df, "src4"), schema)


@query("src5_scoring_batch", """SELECT CAST(c_custkey AS INT) AS sk_id_curr, c_acctbal AS balance,
    0 AS unknown_feature FROM customer""")
def _src5(d):
    batch = d.table("customer").select(
        F.col("c_custkey").alias("sk_id_curr"), F.col("c_acctbal").alias("balance"), "c_name")
    return align_columns(
        read_csv(d.spark, _csv(d, batch, "src5")), ["sk_id_curr", "balance", "unknown_feature"])


@query("snk1_partitioned_overwrite", """SELECT DATE '2001-08-01' AS ingest_date, count(*) AS n,
    sum(c_custkey)::BIGINT AS keys FROM customer UNION ALL SELECT DATE '2001-08-02', count(*),
    sum(c_custkey + 1)::BIGINT FROM customer""")
def _snk1(d):
    lake, df = _lake(d, "snk1"), d.table("customer").select("c_custkey", "c_name")
    for rows in (df.withColumn("c_custkey", F.lit(-1)), df):
        lake.replace(stamp_ingest(rows, DAY_ONE), "customer", ["ingest_date"])
    second = df.withColumn("c_custkey", F.col("c_custkey") + 1)
    lake.replace(stamp_ingest(second, DAY_TWO), "customer", ["ingest_date"], True)
    days = [lake.read("customer", day) for day in (DAY_ONE, DAY_TWO)]
    return days[0].unionByName(days[1]).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query("snk2_overwrite_schema", "SELECT o_orderkey, o_totalprice FROM orders")
def _snk2(d):
    lake = _lake(d, "snk2")
    lake.replace(d.table("orders").select("o_orderkey", "o_orderpriority"), "orders")
    lake.replace(d.table("orders").select("o_orderkey", "o_totalprice"), "orders")
    return lake.read("orders")


@query("snk3_overwrite_rows", "SELECT p_partkey, p_size + 1 AS p_size FROM part")
def _snk3(d):
    lake, df = _lake(d, "snk3"), d.table("part").select("p_partkey", "p_size")
    lake.replace_rows(df, "part")
    lake.replace_rows(df.withColumn("p_size", F.col("p_size") + 1), "part")
    return lake.read("part")


@query("snk4_csv_export", "SELECT CAST(p_partkey AS INT) AS p_partkey, p_brand FROM part")
def _snk4(d):
    path = scratch_folder(d.spark, "snk4")
    export_csv(d.table("part").select("p_partkey", "p_brand"), path, sep=";", n_files=1)
    return read_csv(d.spark, path, sep=";")


@query("snk5_scores", """SELECT CAST(c_custkey AS INT) AS sk_id_curr,
    c_acctbal / 16384 AS prediction_score FROM customer""")
def _snk5(d):
    path = scratch_folder(d.spark, "snk5")
    export_scores(
        d.table("customer").select(
            F.col("c_custkey").alias("sk_id_curr"), "c_name",
            (F.col("c_acctbal") / 16384).alias("prediction_score")), path)
    return read_csv(d.spark, path)


@query("cat1_registered_tables", """SELECT r_name, count(*) AS n FROM region JOIN nation
    ON r_regionkey = n_regionkey GROUP BY 1""")
def _cat1(d):
    lake = _lake(d, "cat1")
    for name in ("region", "nation"):
        lake.replace(d.table(name), name)
    lake.register(["region", "nation"], prefix="cat1_")
    return d.spark.sql("""SELECT r_name, count(*) AS n FROM cat1_region JOIN cat1_nation
        ON r_regionkey = n_regionkey GROUP BY r_name""")


@query("cat1_tables_in_a_new_session", """SELECT r_name, count(*) AS n, sum(o_orderkey)::BIGINT AS keys
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def _cat1_new_session(d):
    lake, database = _lake(d, "cat1"), f"lake_{uuid.uuid4().hex[:12]}"
    for name in ("region", "nation", "customer"):
        lake.replace(d.table(name), name)
    lake.replace(d.table("orders").withColumn("part", F.col("o_orderkey") % 3), "orders", ["part"])
    Lake(d.spark, lake.base).create_tables(database)
    other = d.spark.newSession()
    return other.sql(f"""SELECT r_name, count(*) AS n, sum(o_orderkey) AS keys FROM {database}.region
        JOIN {database}.nation ON r_regionkey = n_regionkey JOIN {database}.customer ON c_nationkey = n_nationkey
        JOIN {database}.orders ON o_custkey = c_custkey GROUP BY r_name""")


@query("ing2_rejected_lines", """SELECT 'customer' AS name, count(*) FILTER (WHERE c_custkey % 10 > 1) AS n,
    count(*) FILTER (WHERE c_custkey % 10 < 2) AS rejected,
    (sum(c_custkey) FILTER (WHERE c_custkey % 10 > 1))::BIGINT AS keys,
    count(*) FILTER (WHERE c_custkey % 10 < 2) AS lines FROM customer""")
def _ing2_rejected(d):
    """Lines with a word where a number belongs, or a field too many, are reported, not lost or made NULL."""
    raw, bronze = scratch_folder(d.spark, "ing2"), _lake(d, "ing2_bronze")
    balance = F.when(F.col("c_custkey") % 10 == 0, "unknown").otherwise(F.col("c_acctbal").cast("string"))
    more = F.when(F.col("c_custkey") % 10 == 1, ",one,more").otherwise("")
    text = F.concat_ws("", F.concat_ws(",", "c_custkey", "c_name", balance), more)
    header = d.spark.createDataFrame([("SK_ID_CURR,NAME,AMT_BALANCE",)], "value string")
    header.unionByName(d.table("customer").select(text.alias("value"))).coalesce(1).write.text(f"{raw}/customer.csv")
    loaded = ingest_table(raw, bronze, "customer", DAY_ONE)
    kept, lines = bronze.read("customer"), bronze.read("customer_rejected")
    return kept.agg(
        F.lit(loaded.table).alias("name"), F.lit(loaded.rows).cast("long").alias("n"),
        F.lit(loaded.rejected).cast("long").alias("rejected"), F.sum("sk_id_curr").alias("keys"),
    ).withColumn("lines", lines.agg(F.count(F.lit(1))).scalar())


@query("ing1_stamp", """SELECT n_name, DATE '2001-08-01' AS ingest_date,
    '2001-08-01 06:30:00' AS ingested FROM nation""")
def _ing1(d):
    stamped = stamp_ingest(d.table("nation"), DAY_ONE, dt.datetime(2001, 8, 1, 6, 30))
    return stamped.select(
        "n_name", "ingest_date",
        F.date_format("ingest_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"))


@query("ing2_ingest_tables", """SELECT 'bureau' AS name, DATE '2001-08-01' AS ingest_date,
    count(*) AS n FROM bureau UNION ALL
    SELECT 'pos_cash_balance', DATE '2001-08-01', count(*) FROM pos""")
def _ing2(d):
    raw, bronze = scratch_folder(d.spark, "ing2"), _lake(d, "ing2_bronze")
    export_csv(d.role("bureau").drop("ingest_date"), f"{raw}/bureau.csv")
    export_csv(d.role("pos"), f"{raw}/POS_CASH_balance.csv")
    ingest_tables(raw, bronze, ["bureau", "POS_CASH_balance"], DAY_ONE)
    a, b = [
        bronze.read(n, DAY_ONE).groupBy(F.lit(n).alias("name"), "ingest_date").agg(
            F.count(F.lit(1)).alias("n"))
        for n in ("bureau", "pos_cash_balance")
    ]
    return a.unionByName(b)


RAW_ROLES = {
    "application_train": "application", "application_test": "applicant", "bureau": "bureau",
    "bureau_balance": "bureau_balance", "previous_application": "previous",
    "POS_CASH_balance": "pos", "credit_card_balance": "card", "installments_payments": "instalments",
}


@query("pipe1_layers", """WITH f AS (SELECT sk_id_curr, count(*) AS n FROM application GROUP BY 1),
    k AS (SELECT sk_id_curr, sum(amt_credit) AS credit FROM (
        SELECT DISTINCT sk_id_curr, name_contract_type, name_type_suite, amt_credit, amt_annuity,
          amt_goods_price, amt_income_total FROM application) GROUP BY 1),
    e AS (SELECT sk_id_curr, occupation_type, count(*) AS n FROM (
        SELECT DISTINCT sk_id_curr, CAST(floor(-days_employed / 365) AS INT) AS y, occupation_type,
          organization_type FROM application) GROUP BY 1, 2)
    SELECT region_population_relative AS region, occupation_type AS occupation,
      sum(credit * f.n * e.n) AS total_disbursed
    FROM f JOIN k USING (sk_id_curr) JOIN e USING (sk_id_curr) JOIN dim_client USING (sk_id_curr)
    GROUP BY ALL""")
def _pipe1(d):
    raw, lake = scratch_folder(d.spark, "raw"), scratch_folder(d.spark, "lake")
    tables = {name: df.drop("ingest_date") for name, df in zip(RAW_ROLES, d.roles(*RAW_ROLES.values()))}
    tables["application_test"] = tables["application_test"].drop("target")
    schemas = {name: df.schema for name, df in tables.items()}
    at_once(d.spark, [
        partial(export_csv, df, f"{raw}/{name}.csv", compression="gzip") for name, df in tables.items()
    ])
    layers = run_layers(d.spark, raw, lake, DAY_ONE, schemas=schemas)
    return layers["gold"].read("origination_sum")
