"""Fitted models kept under a name, with what is needed to use them later.

A model is a folder of its own; beside the models stands a table of cards: name, version,
learner, features, label and metrics.  A card is written after its model, so a model that
was not saved whole is not listed, and an older version stays usable while a newer one
is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import learning
from ledgerloom.sources.files import path_exists

CARD = "name string, version int, learner string, features array<string>, label string, metrics map<string,double>"


@dataclass(frozen=True)
class StoredModel:
    """A fitted pipeline with its card."""

    name: str
    version: int
    learner: str
    features: tuple[str, ...]
    label: str
    metrics: Mapping[str, float]
    pipeline: PipelineModel

    def score(self, df: DataFrame, keep: Sequence[str], name: str = "prediction_score") -> DataFrame:
        """Scores of any table: other columns are left out, absent features count as 0."""
        return learning.score(df, self.pipeline, list(self.features), keep, name)


@dataclass(frozen=True)
class ModelStore:
    """Models below one folder."""

    spark: SparkSession
    base: str

    def _model_path(self, name: str, version: int) -> str:
        return f"{self.base.rstrip('/')}/models/{name}/{version}"

    @property
    def _cards_path(self) -> str:
        return f"{self.base.rstrip('/')}/cards"

    def cards(self) -> DataFrame:
        """One row per saved model and version."""
        if not path_exists(self.spark, self._cards_path):
            return self.spark.createDataFrame([], CARD)
        return self.spark.read.schema(CARD).parquet(self._cards_path)

    def latest(self) -> DataFrame:
        """The cards of the newest version of every name, best AUC first."""
        newest = Window.partitionBy("name").orderBy(F.desc("version"))
        rows = self.cards().withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
        return rows.orderBy(F.desc_nulls_last(F.col("metrics")["auc"]), "name")

    def save(
        self,
        name: str,
        model: PipelineModel,
        features: Sequence[str],
        label: str,
        metrics: Mapping[str, float] | None = None,
        learner: str = "",
    ) -> int:
        """Save a model as the next version of its name; returns the version."""
        if not name or "/" in name or name.startswith("."):
            raise ValueError(f"not a name for a folder: {name!r}")
        if not features:
            raise ValueError("a model needs its list of features")
        last = self.cards().where(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        # A folder without a card is what a failed save left behind.
        model.write().overwrite().save(self._model_path(name, version))
        card = (name, version, learner, list(features), label, {k: float(v) for k, v in (metrics or {}).items()})
        self.spark.createDataFrame([card], CARD).coalesce(1).write.mode("append").parquet(self._cards_path)
        return version

    def load(self, name: str, version: int | None = None) -> StoredModel:
        """A model by name, the newest version unless one is given."""
        found = self.cards().where(F.col("name") == name)
        if version is not None:
            found = found.where(F.col("version") == version)
        card = found.orderBy(F.desc("version")).first()
        if card is None:
            have = [r[0] for r in self.cards().select("name").distinct().orderBy("name").limit(50).collect()]
            raise KeyError(f"no model {name!r}, version {version or 'any'}; there are {have}")
        return StoredModel(
            name, card["version"], card["learner"], tuple(card["features"]), card["label"], dict(card["metrics"]),
            PipelineModel.load(self._model_path(name, card["version"])),
        )

    def fit(
        self,
        train: DataFrame,
        held: DataFrame,
        features: Sequence[str],
        label: str,
        learner: str,
        name: str | None = None,
    ) -> StoredModel:
        """Fit, judge on held-out rows, save with the figures, and load what was saved."""
        model = learning.fit_model(train, features, label, learner)
        scored = learning.score(held, model, features, [label])
        found = learning.judge(scored, label).first()
        metrics = {k: found[k] for k in ("auc", "logloss") if found[k] is not None}
        version = self.save(name or learner, model, features, label, metrics, learner)
        return self.load(name or learner, version)
