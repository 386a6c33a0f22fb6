"""Projection, filters, joins, aggregates, sorts, sets and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feature_sql as fs
from checks.registry import query
from ledgerloom.functions import scalars as sc
from ledgerloom.operators import aggregates as ag
from ledgerloom.operators import cleaning, columns, filters, joins, ranking
from ledgerloom.operators.quantiles import exact_median

# --- projection -------------------------------------------------------------------

query("prj1_select_alias", """SELECT c_custkey AS sk_id_curr, c_mktsegment AS income_type,
    c_acctbal AS balance FROM customer""")(
    lambda d: columns.project(
        d.table("customer"),
        {"c_custkey": "sk_id_curr", "c_mktsegment": "income_type", "c_acctbal": "balance"},
    )
)
query("prj2_cast", """SELECT o_orderkey, CAST(trunc(o_totalprice) AS INT) AS o_totalprice,
    TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS level, CAST(NULL AS INT) AS o_orderstatus
    FROM orders""")(
    lambda d: columns.cast_columns(
        d.table("orders").select(
            "o_orderkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("level"),
            "o_orderstatus",
        ),
        {"o_totalprice": "int", "level": "int", "o_orderstatus": "int"},
    )
)
query("prj3_column_list", f"SELECT sk_id_curr, {', '.join(f'flag_document_{i}' for i in range(2, 22))} FROM application")(
    lambda d: (lambda df: df.select("sk_id_curr", *columns.columns_matching(df, "flag_document")))(
        d.role("application")
    )
)
query("prj4_drop", "SELECT * EXCLUDE (l_tax, l_shipdate) FROM lineitem")(
    lambda d: columns.drop_columns(d.table("lineitem"), ["l_tax", "l_shipdate"])
)
query("prj5_derive", """SELECT l_orderkey, l_extendedprice * l_discount AS off,
    l_quantity + 1 AS more FROM lineitem""")(
    lambda d: d.table("lineitem").withColumns({
        "off": F.col("l_extendedprice") * F.col("l_discount"), "more": F.col("l_quantity") + 1
    }).select("l_orderkey", "off", "more")
)
query("prj6_rename", """SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal
    FROM supplier""")(
    lambda d: columns.rename_columns(d.table("supplier"), {"s_suppkey": "id", "s_name": "name"})
)
query("prj7_aggregate_names", """SELECT sk_id_curr, max(amt_payment) AS ins_amt_payment_max,
    avg(amt_payment) AS ins_amt_payment_mean, coalesce(sum(amt_payment), 0) AS ins_amt_payment_sum
    FROM instalments GROUP BY 1""")(
    lambda d: d.role("instalments").groupBy("sk_id_curr").agg(
        *ag.measures({"amt_payment": ["max", "mean", "sum"]}, "ins_"))
)
query("prj8_join_suffix", """WITH a AS (SELECT sk_id_curr, count(*) AS n FROM previous GROUP BY 1),
    y AS (SELECT sk_id_curr, count(*) AS n, max(amt_credit) AS top FROM previous
          WHERE days_decision >= -365 GROUP BY 1)
    SELECT a.sk_id_curr, a.n, y.n AS n_year, y.top FROM a LEFT JOIN y USING (sk_id_curr)""")(
    lambda d: columns.join_with_suffix(
        d.role("previous").groupBy("sk_id_curr").agg(F.count(F.lit(1)).alias("n")),
        filters.within(d.role("previous"), "days_decision", 365).groupBy("sk_id_curr").agg(
            F.count(F.lit(1)).alias("n"), F.max("amt_credit").alias("top")),
        "sk_id_curr", "_year",
    )
)
query("prj9_first_of_each_name", """SELECT n_nationkey, n_name, n_regionkey, r_regionkey, r_name
    FROM nation JOIN region ON n_regionkey = r_regionkey""")(
    lambda d: columns.first_of_each_name(
        d.table("nation").join(d.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("*", F.lit(0).alias("N_NAME"), F.col("r_name").alias("r_name"))
    )
)
query("prj10_by_name_part", "SELECT l_shipdate::DATE AS l_shipdate FROM lineitem")(
    lambda d: (lambda df: df.select(*[
        F.to_date(c).alias(c) for c in columns.columns_matching(df, "DATE")]))(d.table("lineitem"))
)
query("prj11_by_type", "SELECT o_orderstatus, o_orderpriority FROM orders")(
    lambda d: (lambda df: df.select(*columns.columns_of_type(df, T.StringType)))(d.table("orders"))
)
query("prj12_safe_names", """SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_1_URGENT,
    count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS n_4_NOT_SPECIFIED
    FROM orders GROUP BY 1""")(
    lambda d: d.table("orders").groupBy("o_custkey").agg(*[
        F.count_if(F.col("o_orderpriority") == v).alias(f"n_{columns.safe_name(v)}")
        for v in ("1-URGENT", "4-NOT SPECIFIED")])
)
query("prj13_align", """SELECT c_custkey, c_acctbal, 0 AS not_there, c_nationkey FROM customer""")(
    lambda d: columns.align_columns(
        d.table("customer"), ["c_custkey", "c_acctbal", "not_there", "c_nationkey"])
)
query("prj14_narrow_types", """SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, p_name, p_brand,
    p_type, CAST(p_size AS TINYINT) AS p_size, CAST(p_retailprice AS FLOAT) AS p_retailprice
    FROM part""")(lambda d: columns.narrow_types(d.table("part")))
query("prj15_split_label", """SELECT doc_id, quality, toxic FROM labels""")(
    lambda d: (lambda xy: xy[0].join(xy[1], "doc_id"))(
        columns.split_label(d.table("labels"), "toxic", "doc_id"))
)

# --- filters ------------------------------------------------------------------------

query("flt1_above", "SELECT sk_id_prev, sk_dpd FROM card WHERE sk_dpd > 0")(
    lambda d: filters.above(d.role("card"), "sk_dpd").select("sk_id_prev", "sk_dpd")
)
query("flt2_thresholds", """SELECT num_instalment_number, count(*) AS total,
    count(*) FILTER (WHERE days_instalment > 30) AS above_30,
    count(*) FILTER (WHERE days_instalment > 60) AS above_60,
    count(*) FILTER (WHERE days_instalment > 90) AS above_90 FROM instalments GROUP BY 1""")(
    lambda d: filters.counts_above(
        d.role("instalments"), "days_instalment", [30, 60, 90], ["num_instalment_number"])
)
query("flt3_category", """SELECT sk_id_bureau, amt_credit_sum FROM bureau
    WHERE credit_active = 'Active'""")(
    lambda d: filters.in_category(d.role("bureau"), "credit_active", "Active").select(
        "sk_id_bureau", "amt_credit_sum")
)
query("flt4_week_of_events", """SELECT sk_id_curr, count(*) AS n, sum(cents) AS cents FROM event
    WHERE days_event >= -7 GROUP BY 1""")(
    lambda d: filters.within(d.role("event"), "days_event", 7).groupBy("sk_id_curr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
)
query("flt6_classes", """SELECT target, count(*) AS n, sum(amt_credit) AS credit
    FROM application GROUP BY 1""")(
    lambda d: (lambda parts: parts[0].unionByName(parts[1]))([
        p.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("amt_credit").alias("credit"))
        for p in filters.split_by_class(d.role("application"), "target")])
)
query("flt7_by_key", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    WHERE o_custkey = 42""")(
    lambda d: filters.by_key(d.table("orders"), "o_custkey", 42).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
)
query("flt8_row_count", "SELECT count(*) FILTER (WHERE credit_day_overdue > 0) AS n FROM bureau")(
    lambda d: filters.row_count(d.role("bureau"), F.col("credit_day_overdue") > 0)
)

# --- joins --------------------------------------------------------------------------------

query("jn1_left_other_names", """SELECT c_custkey, c_mktsegment, n_name FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""")(
    lambda d: d.table("customer").alias("c").join(
        d.table("nation").where("n_regionkey < 3").alias("n"),
        F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left",
    ).select("c_custkey", "c_mktsegment", "n_name")
)
query("jn2_inner_other_names", """SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey""")(
    lambda d: d.table("lineitem").join(
        d.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("l_orderkey", "l_linenumber", "o_custkey")
)
query("jn3_inner_composite", """SELECT sk_id_curr, application_date_id, target, employment_years
    FROM fact_application JOIN dim_employment USING (sk_id_curr, application_date_id)""")(
    lambda d: (lambda f, e: f.join(e, ["sk_id_curr", "application_date_id"]).select(
        "sk_id_curr", "application_date_id", "target", "employment_years"))(
            *d.star("fact_application", "dim_employment"))
)
query("jn4_inner_star", """SELECT sk_id_bureau, sk_id_curr, name_income_type FROM fact_bureau
    JOIN dim_client USING (sk_id_curr)""")(
    lambda d: (lambda f, c: f.join(c, "sk_id_curr").select(
        "sk_id_bureau", "sk_id_curr", "name_income_type"))(*d.star("fact_bureau", "dim_client"))
)
query("jn5_full_outer", """SELECT coalesce(a.k, b.k) AS sk_id_curr, coalesce(a.n, 0) AS events,
    coalesce(b.n, 0) AS orders FROM (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) a
    FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) b ON a.k = b.k""")(
    lambda d: joins.outer_total(
        d.table("events").groupBy(F.col("user_id").alias("sk_id_curr")).agg(
            F.count(F.lit(1)).alias("events")),
        d.table("orders").groupBy(F.col("o_custkey").alias("sk_id_curr")).agg(
            F.count(F.lit(1)).alias("orders")),
        "sk_id_curr", ["events", "orders"],
    )
)
query("jn6_two_aggregates", """WITH a AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1),
    o AS (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 30 GROUP BY 1)
    SELECT l_returnflag, CAST(o.n AS DOUBLE) / a.n AS share FROM o JOIN a USING (l_returnflag)""")(
    lambda d: d.table("lineitem").groupBy("l_returnflag").agg(
        ag.conditional_share(F.col("l_quantity") > 30).alias("share")
    ).where("share > 0")
)
query("jn7_bridge", """SELECT sk_id_curr, application_date_id, count(*) AS n FROM instalments
    JOIN (SELECT sk_id_curr, sk_id_prev, application_date_id FROM fact_previous_application)
    USING (sk_id_curr, sk_id_prev) GROUP BY ALL""")(
    lambda d: d.role("instalments").groupBy("sk_id_curr", "sk_id_prev").agg(
        F.count(F.lit(1)).alias("n")
    ).join(
        d.star("fact_previous_application")[0].select(
            "sk_id_curr", "sk_id_prev", "application_date_id"), ["sk_id_curr", "sk_id_prev"]
    ).groupBy("sk_id_curr", "application_date_id").agg(F.sum("n").alias("n"))
)
query("jn8_category_stat", """SELECT p_partkey, p_type, price, m AS median_price FROM product
    LEFT JOIN (SELECT p_type AS t, quantile_disc(price, 0.5) AS m FROM product
      WHERE p_type IS NOT NULL GROUP BY 1) ON p_type = t""")(
    lambda d: joins.attach_category_stat(
        d.role("product").select("p_partkey", "p_type", "price"), "p_type",
        F.percentile_approx("price", 0.5, 10_000_000), "median_price")
)
query("jn9_features_to_spine", """SELECT c_custkey, n, total FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n, sum(floor(o_totalprice)) AS total FROM orders GROUP BY 1)
    ON c_custkey = o_custkey""")(
    lambda d: d.table("customer").select("c_custkey").join(
        d.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor("o_totalprice").cast("double")).alias("total")),
        "c_custkey", "left")
)
query("jn10_stat_on_details", """SELECT l_orderkey, l_linenumber, l_quantity,
    sum(l_quantity) OVER (PARTITION BY l_orderkey) AS order_quantity,
    max(l_quantity) OVER (PARTITION BY l_orderkey) AS largest FROM lineitem""")(
    lambda d: joins.attach_group_stats(
        d.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"],
        {"order_quantity": F.sum("l_quantity"), "largest": F.max("l_quantity")})
)
query("jn11_child_to_parent", """SELECT sk_id_bureau, sk_id_curr, months, worst FROM bureau LEFT JOIN
    (SELECT sk_id_bureau, count(*) AS months, min(months_balance) AS worst FROM bureau_balance
     GROUP BY 1) USING (sk_id_bureau)""")(
    lambda d: d.role("bureau").select("sk_id_bureau", "sk_id_curr").join(
        d.role("bureau_balance").groupBy("sk_id_bureau").agg(
            F.count(F.lit(1)).alias("months"), F.min("months_balance").alias("worst")),
        "sk_id_bureau", "left")
)

# --- aggregates ------------------------------------------------------------------------------


def _group(role, key, **exprs):
    return lambda d: d.role(role).groupBy(key).agg(*[e().alias(n) for n, e in exprs.items()])


query("agg1_row_count", "SELECT event_type, count(*) AS n FROM event GROUP BY 1")(
    _group("event", "event_type", n=lambda: F.count(F.lit(1))))
query("agg2_known_count", "SELECT credit_active, count(amt_annuity) AS n FROM bureau GROUP BY 1")(
    _group("bureau", "credit_active", n=lambda: F.count("amt_annuity")))
query("agg3_sum", "SELECT sk_id_curr, sum(cents) AS cents FROM event GROUP BY 1")(
    _group("event", "sk_id_curr", cents=lambda: F.sum("cents")))
query("agg4_avg", "SELECT sk_id_curr, avg(cents) AS cents FROM event GROUP BY 1")(
    _group("event", "sk_id_curr", cents=lambda: F.avg("cents")))
query("agg5_min_max", """SELECT sk_id_curr, min(days_event) AS first, max(days_event) AS last
    FROM event GROUP BY 1""")(
    _group("event", "sk_id_curr", first=lambda: F.min("days_event"), last=lambda: F.max("days_event")))
query("agg6_rounded", """SELECT sk_id_curr,
    CAST(round(CAST(avg(cents) AS DECIMAL(38, 7)), 2) AS DOUBLE) AS cents FROM event GROUP BY 1""")(
    _group("event", "sk_id_curr", cents=lambda: sc.settled(F.avg("cents"), 2)))
query("agg7_conditional", """SELECT sk_id_curr, count(*) FILTER (WHERE event_type = 'error') AS errors
    FROM event GROUP BY 1""")(
    _group("event", "sk_id_curr", errors=lambda: F.count_if(F.col("event_type") == "error")))
query("agg8_ratio", """SELECT event_type, sum(cents) / nullif(CAST(sum(days_event) AS DOUBLE), 0) AS r
    FROM event GROUP BY 1""")(
    _group("event", "event_type", r=lambda: sc.ratio(F.sum("cents"), F.sum("days_event"))))
query("agg9_avg_of_expression", """SELECT name_contract_type,
    avg(amt_credit / nullif(amt_annuity, 0)) AS term FROM application GROUP BY 1""", ["term"])(
    _group("application", "name_contract_type",
           term=lambda: F.avg(sc.ratio("amt_credit", "amt_annuity"))))
query("agg10_sum_of_sums", """SELECT name_income_type,
    CAST(sum(amt_req_credit_bureau_day) + sum(amt_req_credit_bureau_year) AS BIGINT) AS n
    FROM application GROUP BY 1""")(
    _group("application", "name_income_type",
           n=lambda: F.sum("amt_req_credit_bureau_day") + F.sum("amt_req_credit_bureau_year")))
query("agg11_approximate_median", """SELECT organization_type,
    quantile_disc(amt_income_total, 0.5) AS median FROM application GROUP BY 1""")(
    _group("application", "organization_type",
           median=lambda: F.percentile_approx("amt_income_total", 0.5, 10_000_000)))
query("agg12_exact_median", """SELECT organization_type,
    quantile_cont(amt_income_total, 0.5) AS median FROM application GROUP BY 1""")(
    lambda d: exact_median(d.role("application"), "amt_income_total", ["organization_type"], "median"))
query("agg13_mode", """SELECT cnt_fam_members FROM application WHERE cnt_fam_members IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")(
    lambda d: cleaning.most_frequent(d.role("application"), "cnt_fam_members"))
query("agg14_distinct_count", """SELECT sk_id_curr, count(DISTINCT credit_type) AS types
    FROM bureau GROUP BY 1""")(
    _group("bureau", "sk_id_curr", types=lambda: F.count_distinct("credit_type")))
query("agg15_variance", """SELECT sk_id_curr, var_samp(days_event) AS spread FROM event GROUP BY 1""",
      ["spread"], digits=7)(
    _group("event", "sk_id_curr", spread=lambda: F.var_samp("days_event")))
query("agg16_size", """SELECT sk_id_bureau, count(*) AS size, count(status) AS known
    FROM bureau_balance GROUP BY 1""")(
    _group("bureau_balance", "sk_id_bureau", size=lambda: F.count(F.lit(1)), known=lambda: F.count("status")))
_SPEC = {"sk_dpd": ["max", "mean"], "amt_balance": ["min", "sum"], "cnt_instalment_mature_cum": ["nunique"]}
query("agg17_from_spec", f"SELECT sk_id_curr, {', '.join(fs.spec_sql(_SPEC, 'x_'))} FROM card GROUP BY 1")(
    lambda d: d.role("card").groupBy("sk_id_curr").agg(*ag.measures(_SPEC, "x_")))
_FOUR = {c: fs.FOUR for c in ("cents", "days_event")}
query("agg18_all_numeric",
      f"SELECT event_type, {', '.join(fs.spec_sql(_FOUR, '', ['days_event']))} FROM event GROUP BY 1",
      ["cents_var", "days_event_var"], digits=5)(
    lambda d: (lambda df: df.groupBy("event_type").agg(*ag.measures(
        {c: fs.FOUR for c in columns.numeric_columns(df)})))(
            d.role("event").select("event_type", "cents", "days_event")))
_EVENTS = {"event_type": ["click", "error", "purchase", "signup", "view"]}
query("agg19_category_shares",
      f"SELECT sk_id_curr, {', '.join(fs.shares_sql(_EVENTS, ''))} FROM event GROUP BY 1")(
    lambda d: d.role("event").groupBy("sk_id_curr").agg(*ag.category_shares(_EVENTS)))
_sorted = "list(cnt_instalment ORDER BY months_balance {0}, cnt_instalment {0}) FILTER (WHERE cnt_instalment IS NOT NULL)"
query("agg20_first_last", f"""SELECT sk_id_prev, ({_sorted.format('ASC')})[1] AS first,
    ({_sorted.format('DESC')})[1] AS last FROM pos GROUP BY 1""")(
    _group("pos", "sk_id_prev", first=lambda: ag.first_known("cnt_instalment", "months_balance"),
           last=lambda: ag.last_known("cnt_instalment", "months_balance")))
query("agg21_two_levels", """SELECT sk_id_curr, CAST(sum(n) AS BIGINT) AS n,
    CAST(sum(top) AS BIGINT) AS top FROM (SELECT sk_id_curr, sk_id_prev, count(*) AS n,
      max(sk_dpd) AS top FROM pos GROUP BY 1, 2) GROUP BY 1""")(
    lambda d: d.role("pos").groupBy("sk_id_curr", "sk_id_prev").agg(
        F.count(F.lit(1)).alias("n"), F.max("sk_dpd").alias("top")
    ).groupBy("sk_id_curr").agg(F.sum("n").alias("n"), F.sum("top").alias("top")))
query("agg22_mean_per_key", """SELECT sk_id_curr, avg(amt_income_total) AS income
    FROM application GROUP BY 1""")(
    _group("application", "sk_id_curr", income=lambda: F.avg("amt_income_total")))
query("agg23_global_range", """SELECT min(days_birth) / CAST(365 AS DOUBLE) AS oldest,
    max(days_birth) / CAST(365 AS DOUBLE) AS youngest FROM application""")(
    lambda d: d.role("application").agg(
        sc.years(F.min("days_birth")).alias("oldest"), sc.years(F.max("days_birth")).alias("youngest")))
query("agg24_regrouped_sum", """SELECT sk_id_prev, num_instalment_number, amt_payment,
    sum(amt_payment) OVER (PARTITION BY sk_id_prev, num_instalment_number) AS paid
    FROM instalments""")(
    lambda d: joins.attach_group_stats(
        d.role("instalments").select("sk_id_prev", "num_instalment_number", "amt_payment"),
        ["sk_id_prev", "num_instalment_number"], {"paid": F.sum("amt_payment")}))

# --- windows, sorts, limits, sets ---------------------------------------------------------------

query("win1_first_row", """SELECT sk_id_curr, sk_id_prev, days_decision FROM (SELECT *, row_number() OVER
    (PARTITION BY sk_id_curr ORDER BY days_decision, sk_id_prev) AS row_no FROM previous)
    WHERE row_no = 1""")(
    lambda d: ranking.first_row(
        d.role("previous").select("sk_id_curr", "sk_id_prev", "days_decision"),
        ["sk_id_curr"], ["days_decision", "sk_id_prev"]))
query("srt1_top_one", """SELECT o_orderpriority, count(*) AS total FROM orders GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 1""")(
    lambda d: ranking.frequencies(d.table("orders"), "o_orderpriority", 1))
query("srt2_top_n", """SELECT name_family_status, count(*) AS total FROM application
    WHERE name_family_status IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")(
    lambda d: ranking.frequencies(d.role("application"), "name_family_status", 10))
query("srt3_many_keys", "SELECT sk_id_prev, months_balance, sk_dpd FROM pos ORDER BY 1, 2, 3")(
    lambda d: d.role("pos").select("sk_id_prev", "months_balance", "sk_dpd").orderBy(
        "sk_id_prev", "months_balance", "sk_dpd"))
query("srt4_frequencies", """SELECT event_type, count(*) AS total FROM event GROUP BY 1
    ORDER BY 2 DESC, 1""")(lambda d: ranking.frequencies(d.role("event"), "event_type"))
query("lim1_head_and_tail", """(SELECT event_id, 'head' AS part FROM event ORDER BY 1 LIMIT 5)
    UNION ALL (SELECT event_id, 'tail' AS part FROM event ORDER BY 1 DESC LIMIT 5)""")(
    lambda d: ranking.head(d.role("event"), ["event_id"], 5).select("event_id", F.lit("head").alias("part"))
    .unionByName(ranking.tail(d.role("event"), ["event_id"], 5).select("event_id", F.lit("tail").alias("part"))))
query("set1_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")(
    lambda d: d.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct())
query("set2_distinct_values", "SELECT DISTINCT name_type_suite FROM application")(
    lambda d: ranking.distinct_values(d.role("application"), "name_type_suite"))

# --- scalar functions ----------------------------------------------------------------------------


def _days(sql, spark):
    return sql, lambda d: d.role("application").select("sk_id_curr", "ingest_date", *spark())


SCALARS = {
    "scl1_date_formats": (
        """CAST(strftime(ingest_date, '%Y%m%d') AS INT) AS k, strftime(ingest_date, '%Y') AS y,
        strftime(ingest_date, '%Y-%m') AS ym""",
        lambda: [sc.date_key("ingest_date").alias("k"), F.date_format("ingest_date", "yyyy").alias("y"),
                 sc.month_label("ingest_date").alias("ym")]),
    "scl2_date_parts": (
        """CAST(year(ingest_date) AS INT) AS y, CAST(month(ingest_date) AS INT) AS m,
        CAST(day(ingest_date) AS INT) AS dd, CAST(dayofweek(ingest_date) + 1 AS INT) AS w""",
        lambda: [F.year("ingest_date").alias("y"), F.month("ingest_date").alias("m"),
                 F.dayofmonth("ingest_date").alias("dd"), F.dayofweek("ingest_date").alias("w")]),
    "scl3_shift_days": (
        "CAST(ingest_date + days_registration AS DATE) AS s",
        lambda: [sc.shift_days("ingest_date", "days_registration").alias("s")]),
    "scl4_shift_months": (
        "CAST(ingest_date + to_months(-CAST(sk_id_curr % 40 AS INT)) AS DATE) AS s",
        lambda: [sc.shift_months("ingest_date", -(F.col("sk_id_curr") % 40)).alias("s")]),
    "scl5_to_date": (
        "CAST(CAST(ingest_date AS VARCHAR) AS DATE) AS s",
        lambda: [F.to_date(F.col("ingest_date").cast("string")).alias("s")]),
    "scl6_make_date": (
        "make_date(year(ingest_date), month(ingest_date), 1) AS s",
        lambda: [sc.first_of_month(F.year("ingest_date"), F.month("ingest_date")).alias("s")]),
    "scl8_substring": (
        "substr(strftime(ingest_date, '%Y%m%d'), 1, 6) AS s",
        lambda: [sc.month_of_key(sc.date_key("ingest_date")).alias("s")]),
    "scl9_round": (
        "CAST(round(CAST(amt_credit / 7 AS DECIMAL(38, 15)), 4) AS DOUBLE) AS s",
        lambda: [F.round(F.col("amt_credit") / 7, 4).alias("s")]),
    "scl10_floor": (
        "CAST(floor(-days_employed / 365) AS INT) AS s",
        lambda: [sc.whole_years_ago("days_employed").alias("s")]),
    "scl11_arithmetic": (
        """amt_credit + amt_goods_price - 1 AS a, amt_credit * 2 AS b,
        amt_credit / nullif(amt_annuity, 0) AS c""",
        lambda: [(F.col("amt_credit") + F.col("amt_goods_price") - 1).alias("a"),
                 (F.col("amt_credit") * 2).alias("b"), sc.ratio("amt_credit", "amt_annuity").alias("c")]),
    "scl12_greatest": (
        "greatest(ext_source_1, ext_source_2, ext_source_3) AS s",
        lambda: [F.greatest("ext_source_1", "ext_source_2", "ext_source_3").alias("s")]),
    "scl13_when": (
        "CASE name_income_type WHEN 'BUILDING' THEN 'b' WHEN 'FURNITURE' THEN 'f' ELSE 'other' END AS s",
        lambda: [sc.decode("name_income_type", {"BUILDING": "b", "FURNITURE": "f"}, "other").alias("s")]),
    "scl14_case_text": (
        "CASE WHEN target = 0 THEN 1 ELSE 0 END AS s",
        lambda: [F.expr("CASE WHEN target = 0 THEN 1 ELSE 0 END").alias("s")]),
    "scl15_is_null": (
        "cnt_fam_members IS NULL AS s", lambda: [F.col("cnt_fam_members").isNull().alias("s")]),
    "scl16_at_least_zero": (
        "CASE WHEN ext_source_1 - 0.5 <= 0 THEN 0 ELSE ext_source_1 - 0.5 END AS s",
        lambda: [sc.at_least_zero(F.col("ext_source_1") - 0.5).alias("s")]),
    "scl17_reaches": (
        "CASE WHEN ext_source_1 >= 0.25 THEN 1 ELSE 0 END AS s",
        lambda: [sc.reaches("ext_source_1", 0.25).alias("s")]),
    "scl18_boolean_to_int": (
        "CAST(amt_credit > 100000 AS INT) AS s",
        lambda: [(F.col("amt_credit") > 100000).cast("int").alias("s")]),
    "scl20_years": (
        "days_birth / CAST(365 AS DOUBLE) AS s", lambda: [sc.years("days_birth").alias("s")]),
}
for _name, (_text, _exprs) in SCALARS.items():
    query(_name, f"SELECT sk_id_curr, ingest_date, {_text} FROM application")(
        lambda d, e=_exprs: d.role("application").select("sk_id_curr", "ingest_date", *e()))

query("scl7_today", """SELECT count(*) AS n FROM orders WHERE o_orderdate < now()""")(
    lambda d: d.table("orders").where(
        (F.col("o_orderdate") < F.current_timestamp()) & (F.to_date("o_orderdate") <= F.current_date())
    ).agg(F.count(F.lit(1)).alias("n")))
query("scl19_split", "SELECT unnest(string_split(tags, ',')) AS token FROM product")(
    lambda d: d.role("product").select(F.explode(F.split("tags", ",")).alias("token")))
query("udf1_row_rules", """SELECT sk_id_bureau,
    CASE credit_active WHEN 'Closed' THEN 0 WHEN 'Active' THEN 1 ELSE 2 END AS code,
    CASE WHEN credit_day_overdue > 0 THEN 1 ELSE 0 END AS late,
    CASE WHEN amt_credit_sum - amt_credit_sum_limit <= 0 THEN 0
      ELSE amt_credit_sum - amt_credit_sum_limit END AS room FROM bureau""")(
    lambda d: d.role("bureau").select(
        "sk_id_bureau",
        sc.decode("credit_active", {"Closed": 0, "Active": 1}, 2).alias("code"),
        sc.is_positive("credit_day_overdue").alias("late"),
        sc.at_least_zero(F.col("amt_credit_sum") - F.col("amt_credit_sum_limit")).alias("room")))
