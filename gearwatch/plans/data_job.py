"""Raw CSV to versioned train and test sets.

spark-submit gearwatch/plans/data_job.py INPUT OUTPUT [--failure-col NAME] [--version V]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gearwatch.operators.clean import clean_pipeline
from gearwatch.operators.features import feature_pipeline
from gearwatch.operators.schema import model_columns, sensor_columns
from gearwatch.operators.split import split_pipeline
from gearwatch.operators.timeline import Timeline
from gearwatch.operators.validate import validate_pipeline
from gearwatch.options import LogOptions
from gearwatch.session import run_folder, written
from gearwatch.sources.artifacts import new_version, save_csv
from gearwatch.sources.sensor_log import read_csv_log, timed_rows, untimed_rows


@dataclass(frozen=True)
class DataResult:
    train: DataFrame
    test: DataFrame
    findings: DataFrame | None
    rejects: DataFrame
    train_path: str | None
    test_path: str | None


def ingest_pipeline(
    spark: SparkSession, path: str, options: LogOptions, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Log with valid times, and the rows without.

    Rows are not sorted here: windows order them where order matters.
    """
    log = read_csv_log(spark, path, options, schema)
    return timed_rows(log, options), untimed_rows(log, options)


def run_pipeline(
    log: DataFrame,
    options: LogOptions,
    output: str | None = None,
    sensors: list[str] | None = None,
    version: str | None = None,
    format: str = "parquet",
    validate: bool = True,
    rejects: DataFrame | None = None,
) -> DataResult:
    """Clean, featurise, split, save and check a log."""
    version = version or new_version()
    chosen = sensors or sensor_columns(log, options)
    timeline = Timeline.measure(log, options)
    # The dump, every feature step and their segment tables read the cleaned log: written once.
    cleaned = written(clean_pipeline(log, options, chosen, timeline=timeline), "cleaned")
    if output:
        save_csv(cleaned, f"{output}/cleaned/version={version}")
    # The feature table feeds the threshold, two sets and the checks: written once.
    table = written(feature_pipeline(cleaned, options, chosen, timeline, filled=True), "features")
    train, test, train_path, test_path = split_pipeline(
        table, options, f"{output}/datasets" if output else None, version, format
    )
    findings = None
    if validate:
        findings = validate_pipeline(train, test, options, model_columns(train, options))
    return DataResult(train, test, findings, rejects if rejects is not None else log.limit(0), train_path, test_path)


def main() -> None:
    parser = argparse.ArgumentParser(description="sensor log CSV to train and test sets")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--failure-col", default="Machine failure")
    parser.add_argument("--test-size", type=float, default=LogOptions.test_size)
    parser.add_argument("--version")
    parser.add_argument("--format", default="parquet")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("sensor data").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    options = replace(LogOptions(), failure=args.failure_col, test_size=args.test_size)
    with run_folder(spark):
        log, rejects = ingest_pipeline(spark, args.input, options)
        result = run_pipeline(log, options, args.output, version=args.version, format=args.format, rejects=rejects)
        result.findings.show(50, truncate=False)


if __name__ == "__main__":
    main()
