"""Randomised search with cross-validation; class weights are part of the grid."""

from __future__ import annotations

import math
import random

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.pipeline import PipelineModel
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from gearwatch.operators.models import (
    MAX_FOREST_DEPTH,
    FailureModel,
    TrainingSet,
    boosted_estimator,
    forest_estimator,
    weight_column,
    with_vector,
)
from gearwatch.options import SEED

FOLDS = 5
FOREST_DRAWS = 20
BOOSTED_DRAWS = 50

# The settings that are drawn from. Spark has no minimum of rows to split a
# node, so the forest grid holds the leaf minimum only.
FOREST_GRID = {
    "numTrees": [50, 100, 200, 300],
    "maxDepth": [5, 10, 15, 20, MAX_FOREST_DEPTH],
    "minInstancesPerNode": [1, 2, 4],
    "positive_weight": ["balanced", 10.0, 50.0, 100.0],
}
# Weights of the boosted grid are factors on negatives/positives.
BOOSTED_GRID = {
    "maxDepth": [3, 4, 5, 6, 7, 8],
    "stepSize": [0.01, 0.05, 0.1, 0.15, 0.2],
    "maxIter": [100, 200, 300, 500],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "1.0"],
    "minInstancesPerNode": [1, 3, 5],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3],
    "positive_weight": [0.5, 1.0, 1.5, 2.0],
}


def draw_settings(grid: dict[str, list], draws: int, seed: int = SEED) -> list[dict]:
    """Distinct settings drawn uniformly from the grid; all of it when it is small."""
    size = math.prod(len(v) for v in grid.values())
    chosen = random.Random(seed).sample(range(size), min(draws, size))
    settings = []
    for number in chosen:
        setting = {}
        for name, values in grid.items():
            number, i = divmod(number, len(values))
            setting[name] = values[i]
        settings.append(setting)
    return settings


def search(
    kind: str,
    data: TrainingSet,
    keys: list[str],
    grid: dict[str, list] | None = None,
    draws: int | None = None,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = 4,
) -> tuple[FailureModel, list[tuple[dict, float]]]:
    """Best model by mean F1 of the positive class, and the score of every setting.

    Folds come from a hash of ``keys``, so they do not depend on the partitioning. Each
    weight of the grid is a column of its own, since Spark takes weights as data.
    """
    forest = kind == "random_forest"
    grid = grid or (FOREST_GRID if forest else BOOSTED_GRID)
    settings = draw_settings(grid, draws or (FOREST_DRAWS if forest else BOOSTED_DRAWS), seed)
    estimator = forest_estimator(seed) if forest else boosted_estimator(seed)

    def weights(w) -> tuple[float, float]:
        if w == "balanced":
            return data.balanced
        return 1.0, (w if forest else w * data.ratio)

    used = list(dict.fromkeys(s["positive_weight"] for s in settings))
    fold = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(folds)).cast("int")
    table = with_vector(data.df, data.features).select(
        "features",
        "label",
        fold.alias("fold"),
        *[weight_column(*weights(w)).alias(f"weight{i}") for i, w in enumerate(used)],
    )
    maps = []
    for s in settings:
        params = {estimator.getParam(k): v for k, v in s.items() if k != "positive_weight"}
        params[estimator.weightCol] = f"weight{used.index(s['positive_weight'])}"
        maps.append(params)
    evaluator = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
    fitted = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(table)
    scores = list(zip(settings, map(float, fitted.avgMetrics)))
    best = max(scores, key=lambda pair: pair[1])[0]
    pipeline = PipelineModel([fitted.bestModel])
    return FailureModel(kind, data.features, pipeline, best), scores
