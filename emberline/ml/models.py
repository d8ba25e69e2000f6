"""The three classifiers, their comparison and persistence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.ml import boosting, forest, network
from emberline.ml.evaluate import classification_metrics, leaderboard
from emberline.ml.prep import RiskPrep
from emberline.schemas import CATEGORICAL, CONTINUOUS, FLAGS, LABEL
from emberline.session import spread

FOREST, BOOSTING, NETWORK = "Random Forest", "Gradient Boosting", "Rede Neural (MLP)"
#: Where each saved model lies.
FOLDERS = {FOREST: "forest", BOOSTING: "boosting", NETWORK: "network"}


@dataclass
class Settings:
    """Model sizes; the defaults are the full ones."""

    trees: int = 300
    tree_depth: int = 12
    rounds: int = 300
    round_depth: int = 5
    step: float = 0.1
    hidden: tuple[int, ...] = (64, 32)
    epochs: int = 400
    seed: int = 42


def preparation() -> Pipeline:
    """Clip, impute, scale; one-hot with unknown categories all zero; assemble."""
    return Pipeline(stages=[
        RiskPrep(),
        StringIndexer(inputCols=[f"x_{c}" for c in CATEGORICAL], outputCols=[f"i_{c}" for c in CATEGORICAL],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        # the extra index of unknown categories is the one that is dropped
        OneHotEncoder(inputCols=[f"i_{c}" for c in CATEGORICAL], outputCols=[f"o_{c}" for c in CATEGORICAL],
                      handleInvalid="error", dropLast=True),
        VectorAssembler(inputCols=[f"x_{c}" for c in CONTINUOUS] + [f"o_{c}" for c in CATEGORICAL]
                        + [f"x_{c}" for c in FLAGS], outputCol="features"),
    ])


def feature_names(prepared: PipelineModel) -> list[str]:
    labels = prepared.stages[1].labelsArray
    onehot = [f"{c}={value}" for c, values in zip(CATEGORICAL, labels) for value in values]
    return [*CONTINUOUS, *onehot, *FLAGS]


def fit_classifier(name: str, prepared: DataFrame, inputs: int, settings: Settings = Settings()):
    if name == BOOSTING:
        return boosting.fit(prepared, LABEL, settings.rounds, settings.round_depth, settings.step, seed=settings.seed)
    if name == NETWORK:
        return network.fit(prepared, LABEL, settings.hidden, settings.epochs, inputs, seed=settings.seed)
    if name == FOREST:
        return forest.fit(prepared, LABEL, settings.trees, settings.tree_depth, seed=settings.seed)
    raise ValueError(name)


def positive_probability(scored: DataFrame, name: str = "probabilidade") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


@dataclass
class Comparison:
    preparation: PipelineModel
    models: dict
    metrics: DataFrame
    best: str

    def pipeline(self, name: str | None = None) -> PipelineModel:
        return PipelineModel(stages=[*self.preparation.stages, self.models[name or self.best]])

    def save(self, folder: str) -> None:
        """One model folder per technique, and the winner's."""
        for name in self.models:
            self.pipeline(name).write().overwrite().save(f"{folder}/{FOLDERS[name]}")
        self.pipeline().write().overwrite().save(f"{folder}/modelo")


def compare(train: DataFrame, test: DataFrame, settings: Settings = Settings(),
            names: tuple[str, ...] = (FOREST, BOOSTING, NETWORK)) -> Comparison:
    """Fit each technique on one shared preparation and rank them by F1.

    Every pass of every fit reads ``train``: hand in a stored table.
    """
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    prepared = preparation().fit(train)
    inputs = len(feature_names(prepared))
    ready = spread(prepared.transform(train).select("features", LABEL)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rank(prepared, {name: fit_classifier(name, ready, inputs, settings) for name in names},
                    prepared.transform(test))
    finally:
        for cached in (ready, train):
            cached.unpersist()


def rank(prepared: PipelineModel, models: dict, test: DataFrame) -> Comparison:
    """Fitted models by their F1 on prepared test rows, ties in the order given."""
    held_out = test.select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        for position, (name, model) in enumerate(models.items()):
            scored = positive_probability(model.transform(held_out)).select(
                LABEL, "prediction", "probabilidade").persist(StorageLevel.MEMORY_AND_DISK)
            rows.append((name, position, *classification_metrics(
                scored, LABEL, "prediction", "probabilidade").first()))
            scored.unpersist()
    finally:
        held_out.unpersist()
    schema = ("modelo string, ordem int, acuracia double, precisao double, recall double, f1 double, "
              "auc double, vn bigint, fp bigint, fn bigint, vp bigint")
    metrics = leaderboard(test.sparkSession.createDataFrame(rows, schema))
    return Comparison(prepared, models, metrics, metrics.first()["modelo"])


def write_metrics(metrics: DataFrame, best: str, path: str) -> str:
    metrics.withColumn("melhor", F.col("modelo") == best).write.mode("overwrite").json(path)
    return path
