"""Evaluation against hand-made counts and pair counting."""

import itertools
import random

import pytest
from gearwatch.operators import metrics, profile
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def scored(spark):
    r = random.Random(3)
    rows = [(int(r.random() < 0.4), round(r.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, probability double")
    return rows, df.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


@pytest.mark.parametrize("per_bucket", [500_000, 7])
def test_auc(scored, per_bucket, monkeypatch):
    monkeypatch.setattr(metrics, "AUC_BUCKET_SCORES", per_bucket)
    rows, df = scored
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_one_class(spark):
    df = spark.createDataFrame([(0, 0.2, 0), (0, 0.9, 0)], "label int, probability double, prediction int")
    row = metrics.evaluate(df, "m").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 0, 0, 0)
    assert (row["recall"], row["precision"], row["f1"], row["roc_auc"]) == (0, 0, 0, 0)
    assert profile.class_weights(df, "label").first()["negative_positive_ratio"] == 1.0


def test_cells_and_report(scored):
    rows, df = scored
    tp = sum(y and p > 0.5 for y, p in rows)
    fp = sum(not y and p > 0.5 for y, p in rows)
    fn = sum(y and p <= 0.5 for y, p in rows)
    tn = len(rows) - tp - fp - fn
    row = metrics.classification_metrics(metrics.confusion_matrix(df)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (tn, fp, fn, tp)
    report = {r["class"]: r for r in metrics.per_class_report(df).collect()}
    assert report["1"]["precision"] == pytest.approx(tp / (tp + fp))
    assert report["0"]["recall"] == pytest.approx(tn / (tn + fp))
    assert report["accuracy"]["f1"] == pytest.approx((tp + tn) / len(rows))
    weighted = (report["0"]["f1"] * (tn + fp) + report["1"]["f1"] * (tp + fn)) / len(rows)
    assert report["weighted avg"]["f1"] == pytest.approx(weighted)
    assert report["macro avg"]["support"] == len(rows)


def test_compare(scored):
    _, df = scored
    results = [
        metrics.evaluate(df.withColumn("prediction", (F.col("probability") > c).cast("int")), name)
        for name, c in (("high", 0.9), ("low", 0.1))
    ]
    order = lambda by: [r["model"] for r in metrics.compare_models(results, by).collect()]
    assert order("recall") == ["low", "high"]
    assert order("nonsense") == ["low", "high"]


def test_bands(spark):
    df = spark.createDataFrame([(0.9,), (0.7,), (0.6,), (0.3,), (0.2,)], "p double")
    bands = df.select(metrics.risk_band(F.col("p")).alias("a"), metrics.risk_band(F.col("p"), True).alias("b")).collect()
    assert [r["a"] for r in bands] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert [r["b"] for r in bands] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW"]
    hist = {r["risk_level"]: r["percent"] for r in metrics.risk_histogram(df, "p").collect()}
    assert hist == {"HIGH": 20.0, "MEDIUM": 40.0, "LOW": 40.0}
