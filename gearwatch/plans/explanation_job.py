"""Explain a trained model on a test set.

spark-submit gearwatch/plans/explanation_job.py DATASETS MODELS [--model boosted]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.columns import named
from gearwatch.operators.attribution import (
    additivity,
    attribution_importance,
    summary_points,
    waterfall_points,
    with_attributions,
)
from gearwatch.operators.insights import explanation_checks, high_risk_rows, report_lines, with_explanations
from gearwatch.operators.models import FailureModel, load_model
from gearwatch.options import LogOptions
from gearwatch.session import run_folder, written
from gearwatch.sources.artifacts import cached, latest_version, load_dataset, save_json, save_ranking, save_text

TOP_ROWS = 5
TOP_FEATURES = 20


@dataclass(frozen=True)
class Explained:
    attributed: DataFrame
    validation: DataFrame
    importance: DataFrame
    summary: DataFrame
    waterfall: DataFrame
    high_risk: DataFrame
    report: DataFrame


def explain(
    test: DataFrame,
    model: FailureModel,
    options: LogOptions,
    cache: str | None = None,
    version: str = "",
    key: str = "",
    thresholds: dict | None = None,
) -> Explained:
    """Attributions of all test rows, checked, ranked, and put in words for the riskiest.

    With a ``cache`` folder, ``key`` must name the rows (such as the dataset version), so that
    other rows never meet these attributions.
    """
    if cache and not key:
        raise ValueError("a cache needs a key that names the rows")
    ids = [options.machine, options.time, *options.order]
    ids = [c for c in ids if c in test.columns]
    labelled = options.target in test.columns

    def compute() -> DataFrame:
        keys = [named(c) for c in ids]
        label = [named(options.target).alias("label")] if labelled else []
        scored = with_attributions(model.predict(test), model)
        return scored.select(*keys, *label, "probability", "margin", "prediction", "values", "attributions", "base")

    attributed = (
        cached(test.sparkSession, cache, version, key, compute) if cache else written(compute(), "attributed")
    )
    top = with_explanations(high_risk_rows(attributed, ids, TOP_ROWS), model.features, thresholds)
    return Explained(
        attributed,
        additivity(attributed, model),
        attribution_importance(attributed, model.features),
        summary_points(attributed, model.features, ids, TOP_FEATURES),
        waterfall_points(high_risk_rows(attributed, ids, TOP_ROWS), model.features, ["place", *ids]),
        top,
        report_lines(attributed, top, ids, labelled),
    )


def save(result: Explained, folder: str) -> None:
    save_json(result.validation, f"{folder}/validation")
    save_ranking(result.importance, f"{folder}/importance", "importance", "feature")
    result.summary.write.mode("overwrite").parquet(f"{folder}/summary_points")
    result.waterfall.write.mode("overwrite").parquet(f"{folder}/waterfall_points")
    save_json(result.high_risk.drop("values", "attributions"), f"{folder}/high_risk")
    save_text(result.report, f"{folder}/report")


def main() -> None:
    parser = argparse.ArgumentParser(description="explain a failure model")
    parser.add_argument("datasets")
    parser.add_argument("models")
    parser.add_argument("--model", default="boosted")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("sensor explanations").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with run_folder(spark):
        model, folder = load_model(spark, args.model, base=args.models)
        dataset = latest_version(spark, args.datasets)
        test = load_dataset(spark, args.datasets, "test", version=dataset)
        version = folder.rsplit("models_", 1)[1]
        result = explain(test, model, LogOptions(), f"{folder}/attributions", version, key=f"{dataset}-test")
        save(result, f"{folder}/explanations")
        explanation_checks(result.high_risk, TOP_ROWS).show()
        result.report.orderBy("line_no").select(F.col("line")).show(200, truncate=False)


if __name__ == "__main__":
    main()
