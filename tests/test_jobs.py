"""The three jobs one after the other, and the registered queries as a whole."""

from dataclasses import replace

import brute
import pytest
from gearwatch.operators.models import load_model
from gearwatch.options import LogOptions
from gearwatch.plans import data_job, explanation_job, training_job
from gearwatch.sources import artifacts


def test_jobs(spark, tmp_path):
    frame = brute.random_log(9, rows=600, machines=5, ties=False)
    frame = frame.rename(columns={"failure": "Machine failure", "a": "temperature", "b": "pressure[bar]"})
    frame["Machine failure"] = frame["Machine failure"].map({True: "yes", False: "no"})
    frame.drop(columns="seq").sort_values("timestamp").to_csv(tmp_path / "raw.csv", index=False)
    options = replace(LogOptions(), failure="Machine failure", horizon_hours=4)

    log, rejects = data_job.ingest_pipeline(spark, str(tmp_path / "raw.csv"), options)
    assert rejects.count() == 0
    result = data_job.run_pipeline(log, options, str(tmp_path / "out"), version="20240101_000000", rejects=rejects)
    assert result.train.count() + result.test.count() == len(frame)
    assert result.findings.filter("NOT passed").count() == 0
    cleaned = spark.read.option("header", True).csv(str(tmp_path / "out/cleaned/version=20240101_000000"))
    assert cleaned.count() == len(frame)

    train, test = (artifacts.load_dataset(spark, str(tmp_path / "out/datasets"), s) for s in ("train", "test"))
    trained = training_job.train_all_models(
        train, test, options, str(tmp_path / "models"), optimize=False,
        forest={"numTrees": 3, "maxDepth": 3}, boosted={"maxIter": 3, "maxDepth": 3},
    )
    assert {r["model"] for r in trained.comparison.collect()} == {"baseline", "random_forest", "boosted"}
    recalls = [r["recall"] for r in trained.comparison.collect()]
    assert recalls == sorted(recalls, reverse=True)
    config = artifacts.load_json(spark, f"{trained.folder}/config").first()
    assert config["n_features"] == 24 and config["n_train"] + config["n_test"] == len(frame)
    assert artifacts.load_json(spark, f"{trained.folder}/boosted_report").count() == 5

    model, folder = load_model(spark, "boosted", base=str(tmp_path / "models"))
    explained = explanation_job.explain(test, model, options, f"{folder}/attributions", "v1", key="d1-test")
    explanation_job.save(explained, f"{folder}/explanations")
    assert explained.validation.first()["max_error"] < 1e-9
    assert explained.high_risk.count() == 5
    report = spark.read.text(f"{folder}/explanations/report")
    assert report.filter("value LIKE 'Machine #%'").count() == 5
    assert spark.read.parquet(f"{folder}/explanations/waterfall_points").count() == 5 * 24
    # Rows under another key have attributions of their own; the first key still has its rows.
    fewer = explanation_job.explain(test.limit(7), model, options, f"{folder}/attributions", "v1", key="d2-test")
    again = explanation_job.explain(test.limit(7), model, options, f"{folder}/attributions", "v1", key="d1-test")
    assert fewer.attributed.count() == 7 and again.attributed.count() == explained.attributed.count() > 7


def test_search_in_training(spark):
    frame = brute.random_log(3, rows=300, ties=False)
    df = spark.createDataFrame(frame[["machine_id", "timestamp", "seq", "a", "b", "failure"]].fillna(0.0))
    df = df.withColumn(LogOptions().target, df.failure.cast("int"))
    args = {
        "random_forest": {"grid": {"numTrees": [2], "maxDepth": [2], "positive_weight": ["balanced", 10.0]}, "folds": 2},
        "boosted": {"grid": {"maxIter": [2], "maxDepth": [2], "positive_weight": [1.0]}, "folds": 2},
    }
    result = training_job.train_all_models(df, df, LogOptions(), optimize=True, search_args=args)
    assert result.models["random_forest"].params["positive_weight"] in ("balanced", 10.0)


def test_registry(spark):
    import __spark_entry__ as entry

    names, sqls = set(entry.queries()), set(entry.oracle_sql())
    assert sqls <= names and len(names) > 100
    flagship = entry.entry(spark)
    assert flagship.count() > 0 and "positives" in flagship.columns


SAMPLE = ["cln_interpolate_time", "fea_all", "spl_report", "val_report", "agg_auc", "sco_rules", "src_csv_log"]


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, sf_dir, name):
    import glob
    import os

    import __spark_entry__ as entry
    import duckdb
    from tools.check_oracle import compare

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    text = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)[1]
    assert text.startswith("ok") and "DIFFER" not in text, text


ELSEWHERE = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", "{entry}")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.conf.set("spark.sql.shuffle.partitions", "2")
print("valid", entry.queries()["exp_additivity_boosted"](spark, "{sf}").first()["is_valid"])
"""


def test_executors_need_no_package(sf_dir, tmp_path):
    """A plain session started elsewhere: its Python workers cannot import the package."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    entry = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE.format(entry=entry, sf=sf_dir)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "valid True" in done.stdout, done.stderr[-2000:]
