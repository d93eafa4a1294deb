"""Train, evaluate and compare the three classifiers.

spark-submit gearwatch/plans/training_job.py DATASETS MODELS [--no-optimize]
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.columns import named
from gearwatch.operators.metrics import compare_models, evaluate, per_class_report
from gearwatch.operators.models import (
    FailureModel,
    TrainingSet,
    aligned,
    feature_importance,
    prepare_training,
    train_baseline,
    train_boosted,
    train_random_forest,
)
from gearwatch.operators.profile import class_distribution
from gearwatch.operators.schema import model_columns
from gearwatch.operators.search import search
from gearwatch.options import LogOptions
from gearwatch.session import run_folder, written
from gearwatch.sources.artifacts import latest_version, load_dataset, new_version, save_json, save_ranking


@dataclass(frozen=True)
class TrainingResult:
    models: dict[str, FailureModel]
    metrics: dict[str, DataFrame]
    comparison: DataFrame
    folder: str | None


def model_table(df: DataFrame, features: list[str], options: LogOptions) -> DataFrame:
    """Keys, label and features only, by clean names and without nulls."""
    keys = [c for c in (options.machine, options.time, *options.order) if c in df.columns]
    return df.select(
        *[named(c) for c in keys], named(options.target),
        *[c.alias(f) for c, f in zip(aligned(df, features), features)],
    )


def prepare_features(
    train: DataFrame, test: DataFrame, options: LogOptions, exclude: list[str] | None = None
) -> tuple[TrainingSet, DataFrame]:
    """Training set and the labelled test rows on the same features."""
    data = prepare_training(train, model_columns(train, options, exclude), options.target)
    slim = model_table(data.df.withColumn(options.target, F.col("label")), data.features, options)
    slim = written(slim.withColumnRenamed(options.target, "label"), "train")
    held_out = written(
        model_table(test, data.features, options).withColumnRenamed(options.target, "label"), "test"
    )
    return TrainingSet(slim, data.features, data.negatives, data.positives), held_out


def train_all_models(
    train: DataFrame,
    test: DataFrame,
    options: LogOptions,
    base: str | None = None,
    optimize: bool = True,
    forest: dict | None = None,
    boosted: dict | None = None,
    search_args: dict | None = None,
) -> TrainingResult:
    """Fit, evaluate and (below ``base/models_<version>``) save all models, then compare."""
    spark = train.sparkSession
    version = new_version()
    data, held_out = prepare_features(train, test, options)
    keys = [c for c in (options.machine, options.time, *options.order) if c in data.df.columns]

    def tuned(kind: str) -> FailureModel:
        return search(kind, data, keys, **((search_args or {}).get(kind, {})))[0]

    models = {
        "baseline": train_baseline(data),
        "random_forest": tuned("random_forest") if optimize else train_random_forest(data, **(forest or {})),
        "boosted": tuned("boosted") if optimize else train_boosted(data, **(boosted or {})),
    }
    scored = {
        kind: written(model.predict(held_out).select("label", "prediction", "probability"), f"scored-{kind}")
        for kind, model in models.items()
    }
    metrics = {kind: evaluate(df, kind) for kind, df in scored.items()}
    comparison = compare_models(list(metrics.values()), "recall")
    if base is None:
        return TrainingResult(models, metrics, comparison, None)

    folder = f"{base}/models_{version}"
    for kind, model in models.items():
        model.save(f"{folder}/{kind}")
        save_json(metrics[kind], f"{folder}/{kind}_metrics")
        save_json(per_class_report(scored[kind]), f"{folder}/{kind}_report")
    save_ranking(feature_importance(spark, models["boosted"]), f"{folder}/boosted_importance", "importance", "feature")
    save_ranking(comparison, f"{folder}/comparison", "recall", "model")
    save_json(training_config(data, held_out, options, optimize, version), f"{folder}/config")
    return TrainingResult(models, metrics, comparison, folder)


def training_config(
    data: TrainingSet, held_out: DataFrame, options: LogOptions, optimize: bool, version: str
) -> DataFrame:
    """One row that records what the models were trained on."""
    test_counts = {str(r["label"]): r["row_count"] for r in class_distribution(held_out, "label").collect()}
    row = (
        version, optimize, options.target, len(data.features), data.rows, sum(test_counts.values()),
        json.dumps({"0": data.negatives, "1": data.positives}), json.dumps(test_counts),
    )
    return held_out.sparkSession.createDataFrame(
        [row],
        "version string, optimize boolean, target string, n_features int, n_train long, n_test long, "
        "train_classes string, test_classes string",
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="train and compare failure models")
    parser.add_argument("datasets")
    parser.add_argument("models")
    parser.add_argument("--no-optimize", action="store_true")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("sensor training").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with run_folder(spark):
        # One version for both sets, whatever is committed meanwhile.
        version = latest_version(spark, args.datasets)
        train, test = (load_dataset(spark, args.datasets, side, version=version) for side in ("train", "test"))
        result = train_all_models(train, test, LogOptions(), args.models, optimize=not args.no_optimize)
        result.comparison.show(truncate=False)
        print(f"best model: {result.comparison.first()['model']}")


if __name__ == "__main__":
    main()
