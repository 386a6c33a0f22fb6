"""Split, train, score and judge models with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import ratio, settled
from ledgerloom.operators.columns import align_columns
from ledgerloom.operators.joins import attach_small
from ledgerloom.operators.quantiles import exact_quantiles, running_sums
from ledgerloom.sources.files import written

LEARNERS = {
    "logistic": lambda features, label: LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=20, regParam=0.01
    ),
    "boosted_trees": lambda features, label: GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=10, maxDepth=4, seed=7
    ),
    "linear_svc": lambda features, label: LinearSVC(
        featuresCol=features, labelCol=label, maxIter=20, regParam=0.01
    ),
}


def hash_mark(id_col: str, seed: int = 0) -> Column:
    """A number from 0 to 2^52 that depends on the identifier alone, the same in every engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def stratified_sides(
    df: DataFrame, id_col: str, label: str, share: float = 0.8, seed: int = 0, name: str = "side"
) -> DataFrame:
    """``df`` with a column that says "train" or "held", the same share of each class.

    A row's side depends on a hash of its identifier alone: it is trained on if the
    hash is at most the class's own quantile of it.  Rows without a class go.
    """
    marked = df.withColumn("_mark", hash_mark(id_col, seed).cast("double"))
    bounds = exact_quantiles(marked, "_mark", [share], [label]).select(
        label, F.col("value").alias("_bound")
    )
    side = F.when(F.col("_mark") <= F.col("_bound"), "train").otherwise("held")
    return attach_small(marked, bounds, [label]).select(*df.columns, side.alias(name))


def stratified_split(
    df: DataFrame, id_col: str, label: str, share: float = 0.8, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The two sides as tables; each scans ``df`` anew, so store ``stratified_sides`` to use both."""
    sided = stratified_sides(df, id_col, label, share, seed, "_side")
    return tuple(sided.where(F.col("_side") == s).select(*df.columns) for s in ("train", "held"))


def build_estimator(
    features: Sequence[str], label: str, learner: str = "logistic", select: int | None = None
) -> Pipeline:
    """Assemble, scale, optionally keep the ``select`` best features, learn."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled"),
    ]
    used = "_scaled"
    if select is not None:
        selector = UnivariateFeatureSelector(
            featuresCol=used, labelCol=label, outputCol="_selected", selectionMode="numTopFeatures"
        )
        selector.setFeatureType("continuous").setLabelType("categorical")
        stages.append(selector.setSelectionThreshold(select))
        used = "_selected"
    return Pipeline(stages=[*stages, LEARNERS[learner](used, label)])


def model_input(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The features a model needs, absent or NULL ones as 0, beside kept columns."""
    return align_columns(df, [*keep, *features]).na.fill(0, subset=list(features))


def fit_model(
    df: DataFrame, features: Sequence[str], label: str, learner: str = "logistic",
    select: int | None = None,
) -> PipelineModel:
    """A fitted pipeline.  Its stages scan their input many times, so what they need of it is stored first."""
    rows = written(model_input(df, features, [label]), "training")
    return build_estimator(features, label, learner, select).fit(rows)


def tune_model(
    df: DataFrame, features: Sequence[str], label: str, reg_params: Sequence[float], folds: int = 3
) -> CrossValidatorModel:
    """Choose the regularisation of a linear model by cross-validated AUC."""
    estimator = build_estimator(features, label, "linear_svc")
    svc = estimator.getStages()[-1]
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().addGrid(svc.regParam, list(reg_params)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0),
        numFolds=folds,
        seed=7,
    )
    return search.fit(model_input(df, features, [label]))


def score(
    df: DataFrame, model: PipelineModel, features: Sequence[str], keep: Sequence[str],
    name: str = "prediction_score",
) -> DataFrame:
    """Probability of the positive class, or the prediction of a model without one."""
    scored = model.transform(model_input(df, features, keep))
    value = (
        vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
    )
    return scored.select(*keep, value.alias(name))


def log_loss(df: DataFrame, label: str, probability: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    return df.agg(F.avg(loss).alias("logloss"))


# --- cross-validation over tables ------------------------------------------------


def with_folds(df: DataFrame, id_col: str, folds: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """A fold from 0 per row, by a hash of the identifier: the same on every run and engine."""
    return df.withColumn(name, (hash_mark(id_col, seed) % folds).cast("int"))


def cross_scored(
    df: DataFrame, id_col: str, features: Sequence[str], label: str, learner: str,
    parameters: Sequence[float], folds: int = 3, seed: int = 0,
) -> DataFrame:
    """Rows (id, fold, parameter, label, score): every row scored by models that have not seen its fold.

    A parameter is the regularisation of a linear learner.  One fit per fold and parameter.
    """
    rows = with_folds(model_input(df, features, [id_col, label]), id_col, folds, seed)
    parts = []
    for parameter in parameters:
        estimator = build_estimator(features, label, learner)
        last = estimator.getStages()[-1]
        for fold in range(folds):
            model = estimator.copy({last.regParam: float(parameter)}).fit(rows.where(F.col("fold") != fold))
            scored = model.transform(rows.where(F.col("fold") == fold))
            margin = vector_to_array("rawPrediction")[1]
            score_of = vector_to_array("probability")[1] if "probability" in scored.columns else margin
            parts.append(
                scored.select(id_col, "fold", F.lit(float(parameter)).alias("parameter"), label, score_of.alias("score"))
            )
    return reduce(DataFrame.unionByName, parts)


def cross_fitted_rates(
    df: DataFrame, id_col: str, category: str, label: str, parameters: Sequence[float],
    folds: int = 3, seed: int = 0,
) -> DataFrame:
    """The same rows for a model in closed form: the smoothed rate of positives per category.

    A rate is taken over the other folds, with ``parameter`` rows of the overall rate added;
    all folds and parameters come from one aggregate.  Unknown labels are left out; an
    unknown category is one of its own.
    """
    rows = with_folds(df.where(F.col(label).isNotNull()), id_col, folds, seed).select(
        id_col, "fold", F.struct(category).alias("_c"), label
    )
    hit = F.count_if(F.col(label) == 1).alias("_hits")
    per = rows.groupBy("_c", "fold").agg(hit, F.count(F.lit(1)).alias("_n"))
    # At most one row per fold.
    every = per.groupBy("fold").agg(F.sum("_hits").alias("_hits"), F.sum("_n").alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    prior = every.select(
        "fold",
        ratio(F.sum("_hits").over(everything) - F.col("_hits"), F.sum("_n").over(everything) - F.col("_n")).alias("_prior"),
    )
    whole = per.groupBy("_c").agg(F.sum("_hits").alias("_all_hits"), F.sum("_n").alias("_all"))
    others = whole.crossJoin(prior).join(per, ["_c", "fold"], "left").select(
        "_c", "fold", "_prior",
        (F.col("_all_hits") - F.coalesce("_hits", F.lit(0))).alias("_hits"),
        (F.col("_all") - F.coalesce("_n", F.lit(0))).alias("_n"),
    )
    weight = F.col("parameter")
    return (
        attach_small(rows, others, ["_c", "fold"])
        .withColumn("parameter", F.explode(F.array(*[F.lit(float(p)) for p in parameters])))
        .select(
            id_col, "fold", "parameter", label,
            ratio(F.col("_hits") + weight * F.col("_prior"), F.col("_n") + weight).alias("score"),
        )
    )


def grid_metrics(scored: DataFrame, label: str) -> DataFrame:
    """Rows (parameter, fold, n, auc) of a scored long table."""
    cells = scored.groupBy("parameter", "fold").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(auc(scored, label, "score", ["parameter", "fold"]), ["parameter", "fold"], "left")


def ranked_parameters(metrics: DataFrame) -> DataFrame:
    """Rows (parameter, folds, auc, place): mean AUC over the folds, ties to the smaller parameter.

    Place 1 is the chosen one.  A grid has few parameters, so they are ranked in one task.
    """
    means = metrics.groupBy("parameter").agg(F.count("auc").alias("folds"), settled(F.avg("auc"), 9).alias("auc"))
    order = Window.orderBy(F.desc_nulls_last("auc"), "parameter")
    return means.withColumn("place", F.row_number().over(order))


def tune_by_folds(
    df: DataFrame, id_col: str, features: Sequence[str], label: str, learner: str,
    parameters: Sequence[float], folds: int = 3, seed: int = 0,
) -> tuple[float, PipelineModel, DataFrame]:
    """The chosen parameter, the model refitted with it on all rows, and the ranked parameters."""
    scored = cross_scored(df, id_col, features, label, learner, parameters, folds, seed)
    ranked = ranked_parameters(grid_metrics(scored, label))
    best = ranked.where("place = 1").first()["parameter"]
    estimator = build_estimator(features, label, learner)
    estimator = estimator.copy({estimator.getStages()[-1].regParam: best})
    return best, estimator.fit(model_input(df, features, [label])), ranked


# --- figures -----------------------------------------------------------------------


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, exactly and lazily: rows (by..., auc).

    Scores are counted, ties count half, and the negatives below each score come from
    prefix sums over ranges of scores.  NULL without both classes; rows without a label or
    score are left out.
    """
    by = list(by)
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    hit = (F.col(label) == 1).cast("bigint")
    rows = known.select(*by, F.col(score).cast("double").alias("_score"), hit.alias("_pos"), (1 - hit).alias("_neg"))
    sums = running_sums(rows, "_score", ["_pos", "_neg"], by)
    whole = "decimal(38,0)"
    won = F.sum(F.col("_pos").cast("decimal(19,0)") * (2 * F.col("_neg_before") + F.col("_neg")).cast("decimal(19,0)"))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double") * 2
    return sums.groupBy(*by).agg(ratio(won.cast(whole).cast("double"), pairs).alias("auc"))


def judge(df: DataFrame, label: str, probability: str = "prediction_score") -> DataFrame:
    """One row with hold-out AUC and log-loss."""
    found = auc(df, label, probability).scalar()
    return log_loss(df, label, probability).select(found.alias("auc"), "logloss")
