"""Profiles of columns, and models."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.star_sql import DOCS
from ledgerloom.operators import learning, profile
from ledgerloom.sources import scratch_folder, written
from ledgerloom.sources.models import ModelStore

query("eda1_value_counts", """SELECT name_contract_type, count(*) AS total FROM application
    GROUP BY 1""")(lambda d: profile.value_counts(d.role("application"), "name_contract_type"))
query("eda2_class_shares", """SELECT target, count(*) AS n,
    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM application) * 100 AS pct
    FROM application GROUP BY 1""")(lambda d: profile.class_shares(d.role("application"), "target"))
query("eda3_target_rate", """SELECT name_family_status, count(*) FILTER (WHERE target = 1) AS hits,
    count(target) AS total, avg(target) AS avg FROM application
    WHERE name_family_status IS NOT NULL GROUP BY 1""")(
    lambda d: profile.target_rate(d.role("application"), "name_family_status", "target"))
query("eda3_target_rate_top", """SELECT organization_type, count(*) FILTER (WHERE target = 1) AS hits,
    count(target) AS total, avg(target) AS avg FROM application GROUP BY 1
    ORDER BY total DESC, 1 LIMIT 5""")(
    lambda d: profile.target_rate(d.role("application"), "organization_type", "target", 5))


def _grid(table, column, percents, by=""):
    pcts = ", ".join(f"CAST({p} AS DOUBLE)" for p in percents)
    probs = ", ".join(f"CAST({p / 100!r} AS DOUBLE)" for p in percents)
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return (f"SELECT {lead}unnest([{pcts}]) AS pct, "
            f"unnest(quantile_cont(CAST({column} AS DOUBLE), [{probs}])) AS value FROM {table} {group}")


FIVES = list(range(0, 101, 5))
TENS = list(range(0, 101, 10))
TOP = [round(99 + i / 10, 1) for i in range(11)]
query("eda4_percentiles_by_class", _grid("application", "amt_income_total", FIVES, "target"),
      ["value"], digits=6)(
    lambda d: profile.percentile_grid(d.role("application"), "amt_income_total", FIVES, ["target"]))
query("eda5_percentiles", _grid("bureau", "credit_day_overdue", TENS), ["value"], digits=6)(
    lambda d: profile.percentile_grid(d.role("bureau"), "credit_day_overdue", TENS))
query("eda5_top_percentiles", _grid("bureau", "credit_day_overdue", TOP), ["value"], digits=6)(
    lambda d: profile.percentile_grid(d.role("bureau"), "credit_day_overdue", TOP))


def _bins(table, column, bins, by=""):
    lead = f"{by}, " if by else ""
    return f"""WITH r AS (SELECT CAST(min({column}) AS DOUBLE) AS a, CAST(max({column}) AS DOUBLE) AS z
        FROM {table}),
      b AS (SELECT {lead}a, z, CAST(least(floor((CAST({column} AS DOUBLE) - a) / (z - a) * {bins}),
          {bins - 1}) AS INT) AS bin FROM {table}, r WHERE {column} IS NOT NULL)
      SELECT {lead}bin, a + (z - a) / {bins} * bin AS lo, a + (z - a) / {bins} * (bin + 1) AS hi,
        count(*) AS n FROM b GROUP BY ALL"""


query("eda6_histogram_10", _bins("application", "days_birth", 10), ["lo", "hi"])(
    lambda d: profile.histogram(d.role("application"), "days_birth", 10))
query("eda6_histogram_50", _bins("bureau", "days_credit", 50), ["lo", "hi"])(
    lambda d: profile.histogram(d.role("bureau"), "days_credit", 50))
query("eda7_density", f"""WITH h AS ({_bins('application', 'amt_annuity', 50, 'target')}),
    t AS (SELECT target, count(*) AS n FROM application WHERE amt_annuity IS NOT NULL GROUP BY 1)
    SELECT target, bin, (lo + hi) / 2 AS x, h.n / (t.n * (hi - lo)) AS density
    FROM h JOIN t USING (target)""", ["x", "density"])(
    lambda d: profile.density(d.role("application"), "amt_annuity", 50, "target"))

query("eda7_kernel_density", """WITH v AS (SELECT target, CAST(amt_annuity AS DOUBLE) AS v FROM application
      WHERE amt_annuity IS NOT NULL AND target IS NOT NULL),
    s AS (SELECT target, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS a, max(v) AS z
      FROM v GROUP BY 1 HAVING stddev_samp(v) > 0),
    g AS (SELECT target, n, h, a - 3 * h AS lo, z + 3 * h AS hi, (z + 3 * h - (a - 3 * h)) / 1024.0::DOUBLE AS step FROM s),
    p AS (SELECT target, (v - lo) / step AS spot FROM v JOIN g USING (target)),
    w AS (SELECT target, node, sum(weight) AS weight FROM (
      SELECT target, floor(spot) AS node, 1 - spot + floor(spot) AS weight FROM p UNION ALL
      SELECT target, floor(spot) + 1, spot - floor(spot) FROM p) GROUP BY ALL),
    c AS (SELECT *, lo + (hi - lo) * point / 99.0::DOUBLE AS x FROM g, (SELECT unnest(range(100))::INT AS point))
    SELECT target, point, x, sum(weight * exp(-0.5::DOUBLE * pow((x - lo - node * step) / h, 2)))
      / (n * h * sqrt(2 * pi())) AS density FROM c JOIN w USING (target) GROUP BY target, point, x, n, h""",
      ["x", "density"])(
    lambda d: profile.kernel_density(d.role("application"), "amt_annuity", "target"))


def _boxes(table, column, by):
    keys = ", ".join(by)
    on = f"USING ({keys})"
    return f"""WITH q AS (SELECT {keys}, quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST({column} AS DOUBLE), 0.5) AS med,
        quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {table} GROUP BY ALL),
      v AS (SELECT {keys}, q1, med, q3, CAST({column} AS DOUBLE) AS x,
          x >= q1 - (q3 - q1) * CAST(1.5 AS DOUBLE) AND x <= q3 + (q3 - q1) * CAST(1.5 AS DOUBLE)
          AS inside FROM {table} JOIN q {on} WHERE {column} IS NOT NULL)
      SELECT {keys}, q1, med, q3, min(x) FILTER (WHERE inside) AS lo,
        max(x) FILTER (WHERE inside) AS hi, count(*) FILTER (WHERE NOT inside) AS outliers
      FROM v GROUP BY {keys}, q1, med, q3"""


query("eda8_boxes", _boxes("application", "amt_credit", ["name_contract_type", "code_gender", "target"]))(
    lambda d: profile.box_stats(
        d.role("application"), ["name_contract_type", "code_gender", "target"], "amt_credit"))
query("eda8_boxes_by_status", _boxes("bureau", "days_credit", ["credit_active"]))(
    lambda d: profile.box_stats(d.role("bureau"), ["credit_active"], "days_credit"))
query("eda9_describe", """SELECT count(days_employed) AS count, avg(days_employed) AS mean,
    stddev_samp(days_employed) AS std, CAST(min(days_employed) AS DOUBLE) AS min,
    quantile_cont(CAST(days_employed AS DOUBLE), 0.25) AS p25,
    quantile_cont(CAST(days_employed AS DOUBLE), 0.5) AS p50,
    quantile_cont(CAST(days_employed AS DOUBLE), 0.75) AS p75,
    CAST(max(days_employed) AS DOUBLE) AS max FROM application""", ["mean", "std"], digits=4)(
    lambda d: profile.describe(d.role("application"), "days_employed"))
NULLABLE = ["name_family_status", "cnt_fam_members", "amt_annuity", "ext_source_1", "target"]
query("eda10_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM application"
    for c in NULLABLE))(lambda d: profile.null_counts(d.role("application"), NULLABLE))
query("eda11_flag_shares", " UNION ALL ".join(f"""SELECT '{c}' AS "column", p AS pct0,
    round(100 - p, 2) AS pct1 FROM (SELECT round(count(*) FILTER (WHERE {c} = 0) * 100
      / CAST(count(*) AS DOUBLE), 2) AS p FROM application)""" for c in DOCS))(
    lambda d: profile.flag_shares(d.role("application"), DOCS))
query("eda12_relation", """SELECT target, count(*) AS n, corr(amt_credit, amt_annuity) AS corr
    FROM application WHERE amt_annuity IS NOT NULL GROUP BY 1""", ["corr"])(
    lambda d: profile.relation(d.role("application"), "amt_credit", "amt_annuity", "target"))


def _bin_of(c, r):
    return f"CAST(least(floor(({c} - {r}0) / ({r}1 - {r}0) * 20), 19) AS INT)"


query("eda12_relation_bins", f"""WITH r AS (SELECT min(amt_credit) AS x0, max(amt_credit) AS x1,
      min(amt_annuity) AS y0, max(amt_annuity) AS y1 FROM application)
    SELECT target, {_bin_of('amt_credit', 'x')} AS x_bin, {_bin_of('amt_annuity', 'y')} AS y_bin,
      count(*) AS n FROM application, r WHERE amt_annuity IS NOT NULL GROUP BY ALL""")(
    lambda d: profile.relation_bins(d.role("application"), "amt_credit", "amt_annuity", "target", 20))
query("eda13_token_counts", """SELECT token, count(*) AS total FROM
    (SELECT unnest(string_split(tags, ',')) AS token FROM product) GROUP BY 1""")(
    lambda d: profile.token_counts(d.role("product"), "tags"))
query("eda14_shape", """SELECT count(*) AS n_rows, 5 AS n_columns,
    'event_id,sk_id_curr,event_type,cents,days_event' AS names FROM event""")(
    lambda d: profile.shape(d.role("event")))

# --- models -----------------------------------------------------------------------

FEATURES = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "ext_source_1",
            "ext_source_2", "ext_source_3", "days_birth", "cnt_children"]


def _people(d):
    """Applicants whose label leans on an external score, so that there is something to learn."""
    return d.role("applicant").withColumn(
        "target", F.when(F.col("ext_source_2") < 0.3, 1).otherwise(F.col("target")))


PEOPLE = """people AS (SELECT * REPLACE (CASE WHEN ext_source_2 < 0.3 THEN 1 ELSE target END AS target),
      ('0x' || substr(md5('1:' || sk_id_curr), 1, 13))::BIGINT AS mark FROM applicant)"""
SIDES = f"""{PEOPLE}, bounds AS (SELECT target, quantile_cont(CAST(mark AS DOUBLE), 0.8) AS bound FROM people
      WHERE target IS NOT NULL GROUP BY 1),
    sides AS (SELECT people.*, CASE WHEN mark <= bound THEN 'train' ELSE 'held' END AS side
      FROM people JOIN bounds USING (target))"""


@query("ml1_stratified_split", f"WITH {SIDES} SELECT target, count(*) AS n, side FROM sides GROUP BY ALL")
def _ml1(d):
    sided = learning.stratified_sides(_people(d), "sk_id_curr", "target", 0.8, seed=1)
    return sided.groupBy("target", "side").agg(F.count(F.lit(1)).alias("n"))


query("ml1_held_rows", f"WITH {SIDES} SELECT sk_id_curr, target FROM sides WHERE side = 'held'")(
    lambda d: learning.stratified_split(_people(d), "sk_id_curr", "target", 0.8, seed=1)[1]
    .select("sk_id_curr", "target"))


def _sides(d):
    """Both sides of the applicants' model columns, stored once: fitting and scoring read them again and again."""
    people = _people(d).select("sk_id_curr", "target", *FEATURES)
    sided = written(learning.stratified_sides(people, "sk_id_curr", "target", 0.8, seed=1), "sides")
    return [sided.where(F.col("side") == s).drop("side") for s in ("train", "held")]


def _scored(d, learner):
    train, held = _sides(d)
    model = learning.fit_model(train, FEATURES, "target", learner)
    return learning.score(held, model, FEATURES, ["sk_id_curr", "target"])


query("ml2_score_logistic")(lambda d: _scored(d, "logistic"))
query("ml2_score_boosted_trees")(lambda d: _scored(d, "boosted_trees"))


@query("ml2_stored_model", f"""WITH {SIDES} SELECT name, 1 AS version, 9 AS n_features, count(*) AS n,
    CAST(0 AS BIGINT) AS differing FROM sides, (SELECT unnest(['boosted_trees', 'logistic']) AS name)
    WHERE side = 'held' GROUP BY ALL""")
def _ml2_stored(d):
    """Two models saved, found by name in a new store, scoring as in memory despite other columns."""
    base = scratch_folder(d.spark, "ml2")
    train, held = _sides(d)
    out = []
    for learner in ("boosted_trees", "logistic"):
        model = learning.fit_model(train, FEATURES, "target", learner)
        ModelStore(d.spark, base).save(learner, model, FEATURES, "target", {}, learner)
        stored = ModelStore(d.spark, base).load(learner)
        batch = held.select(F.lit("x").alias("unknown"), *reversed(FEATURES), "sk_id_curr")
        both = learning.score(held, model, FEATURES, ["sk_id_curr"], "a").join(
            stored.score(batch, ["sk_id_curr"], "b"), "sk_id_curr", "full")
        out.append(both.agg(
            F.lit(stored.name).alias("name"), F.lit(stored.version).alias("version"),
            F.lit(len(stored.features)).alias("n_features"), F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing")))
    return out[0].unionByName(out[1])


GRID = [1.0, 20.0, 400.0]
CELLS = f"""{PEOPLE}, f AS (SELECT name_education_type AS c, target, CAST(mark % 3 AS INT) AS fold
      FROM people WHERE target IS NOT NULL),
    per AS (SELECT c, fold, count(*) FILTER (WHERE target = 1) AS h, count(*) AS n FROM f GROUP BY ALL),
    every AS (SELECT fold, sum(h) AS h, sum(n) AS n FROM per GROUP BY 1),
    prior AS (SELECT a.fold, CAST(sum(b.h) AS DOUBLE) / CAST(sum(b.n) AS DOUBLE) AS prior
      FROM every a JOIN every b ON a.fold <> b.fold GROUP BY 1),
    rates AS (SELECT k.c, prior.fold, prior, coalesce(sum(h), 0) AS h, coalesce(sum(n), 0) AS n
      FROM (SELECT DISTINCT c FROM f) k CROSS JOIN prior
      LEFT JOIN per ON per.c IS NOT DISTINCT FROM k.c AND per.fold <> prior.fold GROUP BY ALL),
    scored AS (SELECT f.fold, parameter, target, (h + parameter * prior) / (n + parameter) AS score
      FROM f JOIN rates ON f.fold = rates.fold AND f.c IS NOT DISTINCT FROM rates.c
      CROSS JOIN (SELECT unnest({GRID}::DOUBLE[]) AS parameter)),
    ranks AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY parameter, fold, score) - 1) / 2.0 AS r
      FROM scored WINDOW w AS (PARTITION BY parameter, fold ORDER BY score)),
    cells AS (SELECT parameter, fold, count(*) AS n, count(*) FILTER (WHERE target = 1) AS p,
      CAST(sum(r) FILTER (WHERE target = 1) AS DOUBLE) AS s FROM ranks GROUP BY ALL),
    metrics AS (SELECT parameter, fold, n, (s - p * (p + 1) / 2.0) / CAST(p * (n - p) AS DOUBLE) AS auc FROM cells)"""


def _grid_scores(d):
    return learning.cross_fitted_rates(_people(d), "sk_id_curr", "name_education_type", "target", GRID, 3, seed=1)


query("ml3_grid_metrics", f"WITH {CELLS} SELECT parameter, fold, n, auc FROM metrics", ["auc"])(
    lambda d: learning.grid_metrics(_grid_scores(d), "target"))
query("ml3_chosen_parameter", f"""WITH {CELLS} SELECT parameter, count(auc) AS folds, round(avg(auc), 9) AS auc,
    CAST(row_number() OVER (ORDER BY round(avg(auc), 9) DESC NULLS LAST, parameter) AS INT) AS place
    FROM metrics GROUP BY parameter""")(
    lambda d: learning.ranked_parameters(learning.grid_metrics(_grid_scores(d), "target")))


@query("ml3_selected_and_tuned")
def _ml3(d):
    people = _people(d)
    model = learning.fit_model(people, FEATURES, "target", "linear_svc", select=4)
    best = learning.tune_model(people, FEATURES, "target", [0.01, 0.1], folds=2)
    plain = learning.score(people, model, FEATURES, ["sk_id_curr"], "selected")
    return plain.join(
        learning.score(people, best.bestModel, FEATURES, ["sk_id_curr"], "tuned"), "sk_id_curr")


query("ml4_judge")(lambda d: learning.judge(_scored(d, "logistic"), "target"))


JUDGED = f"""WITH {PEOPLE}, s AS (SELECT name_contract_type, 1 - ext_source_2 AS score, target FROM people
      WHERE ext_source_2 IS NOT NULL AND target IS NOT NULL)"""


def _auc_sql(by):
    keys = "".join(f"{c}, " for c in by)
    window = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""(SELECT {keys}(CAST(sum(r) FILTER (WHERE target = 1) AS DOUBLE) - p * (p + 1) / 2.0)
        / CAST(p * (n - p) AS DOUBLE) AS auc FROM (
      SELECT *, rank() OVER (v ORDER BY score) + (count(*) OVER (PARTITION BY {keys}score) - 1) / 2.0 AS r,
        count(*) FILTER (WHERE target = 1) OVER v AS p, count(*) OVER v AS n
      FROM s WINDOW v AS ({window})) GROUP BY {keys}p, n)"""


def _judged(d):
    people = _people(d).where("ext_source_2 IS NOT NULL AND target IS NOT NULL")
    return people.withColumn("prediction_score", 1 - F.col("ext_source_2"))


query("ml4_judge_of_a_known_score", f"""{JUDGED}, l AS (SELECT least(greatest(score, 1e-15), 1 - 1e-15) AS p, target
      FROM s) SELECT (SELECT auc FROM {_auc_sql([])}) AS auc,
      avg(-(CASE WHEN target = 1 THEN ln(p) ELSE ln(1 - p) END)) AS logloss FROM l""", ["auc", "logloss"])(
    lambda d: learning.judge(_judged(d), "target"))
query("ml4_auc_by_contract", f"{JUDGED} SELECT * FROM {_auc_sql(['name_contract_type'])}", ["auc"])(
    lambda d: learning.auc(_judged(d), "target", "prediction_score", ["name_contract_type"]))
