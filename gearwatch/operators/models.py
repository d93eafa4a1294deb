"""The three classifiers on Spark ML, with class weights, prediction and persistence."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.columns import named, once, sanitised
from gearwatch.operators.profile import class_weights
from gearwatch.options import SEED
from gearwatch.sources.files import exists, folders

KINDS = ("baseline", "random_forest", "boosted")
# Names callers may use for the boosted kind.
KIND_ALIASES = {"xgboost": "boosted", "gbt": "boosted"}
MAX_FOREST_DEPTH = 30  # limit of Spark's tree nodes
# Training rows of one task. Learners keep the rows of a task as objects, many times their size in a file.
TASK_ROWS = 200_000

FOREST_DEFAULTS = {"numTrees": 100, "maxDepth": MAX_FOREST_DEPTH, "minInstancesPerNode": 1}
BOOSTED_DEFAULTS = {
    "maxIter": 100,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
}


def kind_of(name: str) -> str:
    kind = KIND_ALIASES.get(name.lower(), name.lower())
    if kind not in KINDS:
        raise ValueError(f"unknown model type {name!r}; use one of {KINDS}")
    return kind


@dataclass(frozen=True)
class FailureModel:
    """Fitted pipeline, the feature names in vector order, and its parameters."""

    kind: str
    features: list[str]
    pipeline: PipelineModel
    params: dict = field(default_factory=dict)

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` of failure, ``margin`` of the raw score, and ``prediction`` at 0.5."""
        scored = self.pipeline.transform(with_vector(df, self.features))
        raw = vector_to_array("rawPrediction")[1]
        return (
            scored.withColumn("margin", raw)
            .withColumn("probability", vector_to_array("probability")[1])
            .withColumn("prediction", F.col("prediction").cast("int"))
            .drop("features", "scaled", "rawPrediction")
        )

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        about = spark.createDataFrame(
            [(self.kind, self.features, json.dumps(self.params, default=str))],
            "kind string, features array<string>, params string",
        )
        about.coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FailureModel":
        if not exists(spark, f"{path}/about"):
            raise FileNotFoundError(f"model not found: {path}")
        about = spark.read.schema("kind string, features array<string>, params string").json(f"{path}/about").first()
        return cls(about["kind"], list(about["features"]), PipelineModel.load(f"{path}/pipeline"), json.loads(about["params"]))


def latest_model_dir(spark: SparkSession, base: str) -> str:
    found = [f for f in folders(spark, base) if f.startswith("models_")]
    if not found:
        raise FileNotFoundError(f"no model folder below {base}")
    return f"{base}/{max(found)}"


def load_model(spark: SparkSession, model_type: str = "boosted", model_dir: str | None = None, base: str | None = None):
    """The model of a type from a folder, or from the newest folder below ``base``."""
    kind = kind_of(model_type)
    folder = model_dir or latest_model_dir(spark, base)
    return FailureModel.load(spark, f"{folder}/{kind}"), folder


def aligned(df: DataFrame, features: list[str]) -> list[Column]:
    """Model features in model order: by name or cleaned name, absent ones and nulls as 0."""
    have = {sanitised(c): c for c in reversed(df.columns)} | {c: c for c in df.columns}
    return [
        F.coalesce(named(have[f]).cast("double"), F.lit(0.0)) if f in have else F.lit(0.0) for f in features
    ]


def missing_features(df: DataFrame, features: list[str]) -> list[str]:
    """Features the model expects and the frame lacks."""
    have = set(df.columns) | {sanitised(c) for c in df.columns}
    return sorted(set(features) - have)


def with_values(df: DataFrame, features: list[str], name: str = "values") -> DataFrame:
    return once(df, name, F.array(*aligned(df, features)))


def with_vector(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(*aligned(df, features))))


@dataclass(frozen=True)
class TrainingSet:
    """Rows with ``label`` and the feature columns, and the class counts of the rows."""

    df: DataFrame
    features: list[str]
    negatives: int
    positives: int

    @property
    def rows(self) -> int:
        return self.negatives + self.positives

    @property
    def balanced(self) -> tuple[float, float]:
        n = self.rows
        return n / (2.0 * max(1, self.negatives)), n / (2.0 * max(1, self.positives))

    @property
    def ratio(self) -> float:
        return self.negatives / self.positives if self.negatives and self.positives else 1.0


def prepare_training(df: DataFrame, features: list[str], label: str) -> TrainingSet:
    """Label and class counts; fails without positives, since nothing could be learned."""
    counts = class_weights(df, label).first()
    if not counts["positives"]:
        raise ValueError(
            f"no positive rows in column {label!r}: check the failure column, its values and the horizon"
        )
    clean = [sanitised(f) for f in features]
    labelled = df.withColumn("label", named(label).cast("double"))
    return TrainingSet(labelled, clean, counts["negatives"], counts["positives"])


def weight_column(negative: float, positive: float) -> Column:
    return F.when(F.col("label") == 1, F.lit(float(positive))).otherwise(F.lit(float(negative)))


def _fit(kind: str, stages: list, data: TrainingSet, weights: tuple[float, float], params: dict) -> FailureModel:
    weighted = with_vector(data.df, data.features).select(
        "features", "label", weight_column(*weights).alias("weight")
    )
    if data.rows > TASK_ROWS:
        # Files are cut at their row groups, which says nothing about the rows of a task.
        tasks = max(math.ceil(data.rows / TASK_ROWS), weighted.sparkSession.sparkContext.defaultParallelism)
        numbered = weighted.withColumn("_row", F.monotonically_increasing_id())
        weighted = numbered.repartition(tasks, "_row").drop("_row")
    model = Pipeline(stages=stages).fit(weighted)
    return FailureModel(kind, data.features, model, params)


def train_baseline(data: TrainingSet, max_iter: int = 1000, c: float = 1.0) -> FailureModel:
    """Standardised features, balanced weights, L2-regularised logistic regression."""
    stages = [
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="scaled",
            weightCol="weight",
            maxIter=max_iter,
            standardization=False,
            # Balanced weights sum to the row count, by which Spark divides the loss.
            regParam=1.0 / (c * data.rows),
        ),
    ]
    return _fit("baseline", stages, data, data.balanced, {"max_iter": max_iter, "c": c})


def forest_estimator(seed: int = SEED, **params) -> RandomForestClassifier:
    return RandomForestClassifier(weightCol="weight", seed=seed, **(FOREST_DEFAULTS | params))


def train_random_forest(data: TrainingSet, seed: int = SEED, **params) -> FailureModel:
    """Forest with balanced weights."""
    return _fit("random_forest", [forest_estimator(seed, **params)], data, data.balanced, params)


def boosted_estimator(seed: int = SEED, **params) -> GBTClassifier:
    return GBTClassifier(weightCol="weight", seed=seed, **(BOOSTED_DEFAULTS | params))


def train_boosted(data: TrainingSet, seed: int = SEED, positive_weight: float | None = None, **params) -> FailureModel:
    """Boosted trees on log loss; positives weigh negatives/positives unless told otherwise."""
    weight = data.ratio if positive_weight is None else positive_weight
    return _fit(
        "boosted", [boosted_estimator(seed, **params)], data, (1.0, weight), params | {"positive_weight": weight}
    )


def feature_importance(spark: SparkSession, model: FailureModel) -> DataFrame:
    """Gain importance per feature, largest first; one row per feature."""
    gains = model.classifier.featureImportances.toArray()
    rows = [(name, float(g)) for name, g in zip(model.features, gains)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
