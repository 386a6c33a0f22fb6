import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import learning
from ledgerloom.sources import export_scores, read_csv
from ledgerloom.sources.models import ModelStore


def people(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("sk_id_curr"),
        (F.col("id") % 10 / 10).alias("x"),
        (F.col("id") * 7 % 13 / 13).alias("noise"),
        F.when(F.col("id") % 10 > 6, 1).otherwise(0).alias("target"),
    )


def test_split_is_stratified_and_repeatable(spark):
    df = people(spark)
    train, held = learning.stratified_split(df, "sk_id_curr", "target", 0.8, seed=3)
    again, _ = learning.stratified_split(df.repartition(7), "sk_id_curr", "target", 0.8, seed=3)
    ids = {r[0] for r in train.select("sk_id_curr").collect()}
    assert ids == {r[0] for r in again.select("sk_id_curr").collect()}
    assert ids.isdisjoint({r[0] for r in held.select("sk_id_curr").collect()})
    assert train.count() + held.count() == df.count()
    for label, size in ((0, 280), (1, 120)):
        assert abs(train.where(F.col("target") == label).count() - 0.8 * size) <= 1


def test_score_and_judge(spark):
    df = people(spark)
    model = learning.fit_model(df, ["x", "noise"], "target")
    scored = learning.score(df.drop("noise"), model, ["x", "noise"], ["sk_id_curr", "target"])
    assert scored.columns == ["sk_id_curr", "target", "prediction_score"]
    found = learning.judge(scored, "target").first()
    assert found["auc"] > 0.95 and 0 < found["logloss"] < 0.7


def test_log_loss_of_a_coin(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    assert abs(learning.log_loss(df, "y", "p").first()[0] - 0.6931471805599453) < 1e-12


def test_selection_and_tuning(spark):
    df = people(spark, 200)
    model = learning.fit_model(df, ["x", "noise"], "target", "linear_svc", select=1)
    assert set(r[0] for r in learning.score(df, model, ["x", "noise"], []).distinct().collect()) <= {0.0, 1.0}
    tuned = learning.tune_model(df, ["x", "noise"], "target", [0.01, 1.0], folds=2)
    assert len(tuned.avgMetrics) == 2


def plain_auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties_and_groups(spark):
    rnd = random.Random(6)
    data = [(rnd.choice("aabc"), rnd.randrange(2), round(rnd.random(), 1)) for _ in range(600)]
    data += [("one", 1, 0.3), ("one", 1, 0.5), ("none", 0, 0.2)]
    df = spark.createDataFrame(data + [("a", None, 0.4), ("a", 1, None)], "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in learning.auc(df, "y", "s", ["g"]).collect()}
    for g in {d[0] for d in data}:
        want = plain_auc([d[1:] for d in data if d[0] == g])
        assert got[g] == (None if want is None else pytest.approx(want))
    assert learning.auc(df, "y", "s").first()["auc"] == pytest.approx(plain_auc([d[1:] for d in data]))
    assert learning.auc(df.limit(0), "y", "s").first()["auc"] is None


def test_judge_is_lazy(spark):
    """No job runs while the plan of ``judge`` is made."""
    df = people(spark).select("target", F.col("x").alias("prediction_score"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("judge", "plan only")
    learning.judge(df, "target")
    assert tracker.getJobIdsForGroup("judge") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_models_are_found_by_name_in_a_new_store(spark, tmp_path):
    df = people(spark)
    held = df.where("sk_id_curr % 4 = 0")
    first = ModelStore(spark, str(tmp_path / "store"))
    assert first.cards().count() == 0
    with pytest.raises(KeyError):
        first.load("nobody")
    for learner in ("logistic", "boosted_trees", "linear_svc"):
        fitted = first.fit(df, held, ["x", "noise"], "target", learner)
        assert fitted.version == 1 and fitted.metrics["auc"] > 0.9
    kept = learning.fit_model(df, ["x"], "target")
    assert first.save("logistic", kept, ["x"], "target", {"auc": 0.5}) == 2

    store = ModelStore(spark, str(tmp_path / "store"))
    assert [r["name"] for r in store.latest().collect()][-1] == "logistic" and store.cards().count() == 4
    old, new = store.load("logistic", 1), store.load("logistic")
    assert (old.features, new.features, new.version) == (("x", "noise"), ("x",), 2)
    batch = held.select(F.lit(1).alias("other"), "x", "sk_id_curr")
    got = {r[0]: r[1] for r in new.score(batch, ["sk_id_curr"]).collect()}
    assert got == {r[0]: r[1] for r in learning.score(held, kept, ["x"], ["sk_id_curr"]).collect()}
    # An absent feature counts as 0.
    assert old.score(batch, ["sk_id_curr"]).count() == held.count()

    export_scores(new.score(batch, ["sk_id_curr"]), str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out")).columns == ["sk_id_curr", "prediction_score"]


@pytest.mark.parametrize("name", ["", "a/b", ".hidden"])
def test_names_that_are_no_folder(spark, tmp_path, name):
    with pytest.raises(ValueError):
        ModelStore(spark, str(tmp_path)).save(name, None, ["x"], "target")


def test_cross_fitted_rates_leave_the_own_fold_out(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice(["a", "b", None, "only once" if i == 7 else "c"]), rnd.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(data + [(900, "a", None)], "id int, c string, y int")
    folds = {r["id"]: r["fold"] for r in learning.with_folds(df, "id", 3, 5).collect()}
    got = learning.cross_fitted_rates(df, "id", "c", "y", [2.0], 3, 5).collect()
    assert len(got) == 200
    known = {i: (c, y) for i, c, y in data}
    for r in got:
        others = [(c, y) for i, (c, y) in known.items() if folds[i] != r["fold"]]
        same = [y for c, y in others if c == known[r["id"]][0]]
        prior = sum(y for _, y in others) / len(others)
        assert r["score"] == pytest.approx((sum(same) + 2 * prior) / (len(same) + 2))


def test_tuning_follows_from_the_table(spark):
    df = people(spark, 300)
    best, model, ranked = learning.tune_by_folds(df, "sk_id_curr", ["x", "noise"], "target", "logistic", [0.01, 5.0], 2)
    places = {r["parameter"]: (r["place"], r["folds"]) for r in ranked.collect()}
    assert places[best] == (1, 2) and len(places) == 2
    assert model.stages[-1].getRegParam() == best
    scored = learning.cross_scored(df, "sk_id_curr", ["x", "noise"], "target", "linear_svc", [0.1], 2)
    assert scored.count() == 300 and scored.select("sk_id_curr").distinct().count() == 300


def test_fitting_reads_its_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [(float(i % 17), float(i * 7 % 5), int(i % 17 > 8)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, target int").mapInPandas(count, "x double, y double, target int")
    learning.fit_model(df, ["x", "y"], "target", "boosted_trees")
    assert seen.value == 200
