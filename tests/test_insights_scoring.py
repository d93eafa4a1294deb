"""Feature names, sentences, reports, requests and the stream."""

import json

import pytest
from gearwatch.operators import insights, models, scoring
from gearwatch.streaming.scorer import request_stream, score_stream
from pyspark.sql import functions as F


def test_feature_names(spark):
    cases = {
        "temperature_lag_1": ("temperature", "lag", "1 time step(s) ago"),
        "pressure_rolling_mean_4h": ("pressure", "rolling_mean", "4h"),
        "vibration_rolling_std_8h": ("vibration", "rolling_std", "8h"),
        "rpm_ema_0.3": ("rpm", "ema", "EMA (alpha=0.3)"),
        "Voltage": ("voltage", "raw", "current"),
        "torque_lag": ("unknown", "lag", "current"),
        "current_ema": ("current", "ema", "current"),
        # The first piece with the letter h wins, wanted or not.
        "head_rolling_mean_1h": ("unknown", "rolling_mean", "head"),
    }
    df = spark.createDataFrame([(c,) for c in cases], "feature string")
    got = {
        r["feature"]: (r["sensor"], r["operation"], r["time_window"])
        for r in insights.parsed_feature_names(df).collect()
    }
    assert got == cases


FEATURES = ["temperature", "pressure_lag_1", "vibration_rolling_mean_1h"]


@pytest.fixture(scope="module")
def explained(spark):
    rows = [(1, 0.85, [91.254, 1.9, 0.02], [0.5, -0.7, 0.0]), (2, 0.1, [20.0, 1.0, 0.0], [-0.1, 0.2, 0.3])]
    df = spark.createDataFrame(rows, "id int, probability double, values array<double>, attributions array<double>")
    return insights.with_explanations(df, FEATURES, {"temperature": {"max": 80.0}}, top_n=2)


def test_explanations(explained):
    row = explained.filter("id = 1").first()
    assert row["risk_level"] == "HIGH"
    assert [f["feature"] for f in row["top_features"]] == ["pressure_lag_1", "temperature"]
    assert row["summary"] == (
        "Failure risk is HIGH (probability: 85.0%).\n\n"
        "Failure risk increased due to:\n"
        "  1. Temperature increased failure risk (value: 91.25 (exceeding safe maximum of 80.0))\n"
        "\nFailure risk decreased due to:\n"
        "  1. Pressure from 1 time step(s) ago decreased failure risk (value: 1.90)\n"
    )
    low = explained.filter("id = 2").first()
    assert [f["feature"] for f in low["positive_factors"]] == ["vibration_rolling_mean_1h", "pressure_lag_1"]
    assert low["negative_factors"] == []


def test_rules_of_explanations(explained):
    assert insights.explanation_checks(explained, 2).first().asDict() == {"checked": 2, "broken": 0}
    assert insights.explanation_checks(explained, 3).first()["broken"] == 2


def test_report(spark, explained):
    scored = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.5, 1), (0.1, 0)], "probability double, label int")
    top = insights.high_risk_rows(explained, ["id"], 5)
    lines = [r["line"] for r in insights.report_lines(scored, top, ["id"]).orderBy("line_no").collect()]
    assert "  High Risk (>70%):   1 machines (25.0%)" in lines
    assert "  Medium Risk (30-70%): 2 machines (50.0%)" in lines
    assert "  True Positives:  1" in lines and "  False Negatives: 1" in lines
    assert lines.index("Machine #1 (Instance 1):") < lines.index("Machine #2 (Instance 2):")


RECORDS = {
    '{"machine_id": "M_17", "temperature": 91.25, "pressure": 2.2, "vibration": 0.03}': None,
    '{"machine_id": "M_1", "temperature": "70", "pressure": 1, "vibration": 0.01, "more": 1}': None,
    "this is no json": "not a JSON object",
    "[1, 2]": "not a JSON object",
    '{"machine_id": "M_17", "temperature": 91.25}': "pressure is missing",
    '{"temperature": 1, "pressure": 1, "vibration": 1}': "machine_id is missing",
    '{"machine_id": "M_2", "temperature": "warm", "pressure": 2.2, "vibration": 0.03}': "temperature is not numeric",
    '{"machine_id": "M_2", "temperature": "82.5d", "pressure": 2.2, "vibration": 0.03}': "temperature is not numeric",
    '{"machine_id": "M_2", "temperature": 1, "pressure": "1f", "vibration": 0.03}': "pressure is not numeric",
    '{"machine_id": "M_2", "temperature": 1, "pressure": -100000.5, "vibration": 0.02}': "pressure is out of range",
    '{"machine_id": "M_2", "temperature": 1, "pressure": 100000, "vibration": 0.02}': None,
}


def test_request_checks(spark):
    df = spark.createDataFrame([(b,) for b in RECORDS], "value string")
    assert {r["value"]: r["reason"] for r in scoring.parse_requests(df).collect()} == RECORDS


def test_request_features(spark):
    names = ["temperature", "pressure", "vibration", "temperature_lag_1", "pressure_rolling_mean_1h", "my_vibration", "x_ema"]
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "temperature double, pressure double, vibration double")
    row = scoring.request_features(df, names).first().asDict()
    assert row == {
        "temperature": 1.0, "pressure": 2.0, "vibration": 3.0, "temperature_lag_1": 1.0,
        "pressure_rolling_mean_1h": 2.0, "my_vibration": 0.0, "x_ema": 0.0,
    }


@pytest.mark.parametrize(
    "readings,p,factors",
    [
        ((81.0, 1.6, 0.02), 0.1, ["High temperature", "Elevated pressure", "High vibration"]),
        ((80.0, 0.2, 0.0), 0.6, ["Temperature within range", "Pressure instability", "Vibration normal"]),
        ((80.0, 1.0, 0.0), 0.5, []),
    ],
)
def test_rule_factors(spark, readings, p, factors):
    df = spark.createDataFrame([readings], "temperature double, pressure double, vibration double")
    assert df.select(scoring.rule_factors(F.lit(p)).alias("f")).first()["f"] == factors


@pytest.fixture(scope="module")
def model(spark):
    rows = [(60.0 + i % 40, 1.0 + (i % 13) / 10, 0.001 * (i % 30), int(i % 40 > 25)) for i in range(300)]
    df = spark.createDataFrame(rows, "temperature double, pressure double, vibration double, y int")
    df = df.withColumn("temperature_lag_1", F.col("temperature")).withColumn("pressure_rolling_mean_1h", F.col("pressure"))
    names = [c for c in df.columns if c != "y"]
    return models.train_boosted(models.prepare_training(df, names, "y"), maxIter=3, maxDepth=3)


@pytest.mark.parametrize("explain", [True, False])
def test_stream_equals_batch(spark, model, tmp_path, explain):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = list(RECORDS) + [
        json.dumps({"machine_id": f"M{i}", "temperature": 60 + i, "pressure": 1 + i / 20, "vibration": i / 1000})
        for i in range(30)
    ]
    for part in range(2):
        (folder / f"part-{part}.json").write_text("\n".join(lines[part::2]) + "\n")
    batch = scoring.score_requests(scoring.valid_requests(scoring.parse_requests(spark.read.text(str(folder)))), model, explain)
    scored, rejected = score_stream(
        request_stream(spark, str(folder), 1), model, str(tmp_path / "out"), str(tmp_path / "state"), explain=explain
    )
    assert scored.count() == 33 and rejected.count() == 8
    assert scored.exceptAll(batch.select(*scored.columns)).count() == 0
    assert scored.filter("size(top_risk_factors) > 3 OR failure_probability NOT BETWEEN 0 AND 1").count() == 0
    if explain:
        hot = scored.filter("failure_probability > 0.7").first()
        assert hot["risk_level"] == "HIGH" and "increased failure risk" in hot["top_risk_factors"][0]
        assert set(hot["shap_explanations"][0].asDict()) == {"feature", "value", "shap_value", "explanation"}


def test_a_repeated_batch_gives_each_record_once(spark, model, tmp_path):
    """Stops after the tables are written and before the batch is committed; starts again."""
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    folder.mkdir()
    record = lambda i: json.dumps({"machine_id": f"M{i}", "temperature": 60 + i, "pressure": 1.0, "vibration": 0.01})
    for part in range(3):
        (folder / f"part-{part}.json").write_text("\n".join([*(record(10 * part + i) for i in range(5)), "no json"]) + "\n")
        scored, rejected = score_stream(request_stream(spark, str(folder), 1), model, out, str(state), explain=False)
        last = max((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    scored, rejected = score_stream(request_stream(spark, str(folder), 1), model, out, str(state), explain=False)
    assert sorted(r["machine_id"] for r in scored.collect()) == sorted(f"M{10 * p + i}" for p in range(3) for i in range(5))
    assert rejected.count() == 3
