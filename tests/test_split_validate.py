"""Split threshold, split sides and leakage checks."""

from dataclasses import replace

import brute
import pytest
from gearwatch.functions.columns import without_nan
from gearwatch.operators import features, split, validate
from gearwatch.operators.target import create_target, failure_flag, target_summary
from gearwatch.operators.timeline import Timeline
from gearwatch.options import LogOptions
from pyspark.sql import functions as F

O = LogOptions()


@pytest.fixture(scope="module")
def frame():
    return brute.random_log(5, gaps=0.0, hot=0.5)


@pytest.fixture(scope="module")
def log(spark, frame):
    return without_nan(spark.createDataFrame(frame)).repartition(3)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.99])
@pytest.mark.parametrize("listed", [100_000, 3])
def test_threshold(log, frame, share, listed, monkeypatch):
    monkeypatch.setattr(split, "LISTED_ROWS", listed)
    us = sorted(brute.ordered(frame)["us"])
    assert split.time_threshold(log, replace(O, test_size=share)) == us[int(len(us) * (1 - share))]


def test_sides(log, frame):
    train, test = split.time_based_split(log, O)
    us = sorted(brute.ordered(frame)["us"])
    edge = us[int(len(us) * 0.8)]
    assert train.count() == sum(u < edge for u in us)
    assert test.count() == sum(u >= edge for u in us)
    report = split.split_report(split.with_split(log, O), O).first()
    assert not report["overlap"] and report["test_first_us"] == edge


def test_empty_test_set(log):
    train, test = split.time_based_split(log, replace(O, test_size=0.0))
    assert (train.count(), test.count()) == (log.count(), 0)


@pytest.mark.parametrize("options", [O, replace(O, group_rows=20)])
def test_time_order(spark, options):
    rows = [("a", i, i) for i in range(60)] + [("b", i, 100 - i % 7) for i in range(60)] + [("c", 0, 5)]
    df = spark.createDataFrame(rows, "machine_id string, seq long, minute long")
    df = df.withColumn("timestamp", F.timestamp_seconds(F.col("minute") * 60)).repartition(4)
    found = {r["machine_id"]: r["violations"] for r in validate.time_order_violations(df, options).collect()}
    times = [100 - i % 7 for i in range(60)]
    assert found == {"b": sum(a > b for a, b in zip(times, times[1:]))}


def test_findings(log):
    labelled = create_target(log, O)
    train, test = split.time_based_split(labelled, O)
    findings = validate.validate_pipeline(train, test, O, ["a_lag_1", "lead_time", "a_ahead"])
    # Row order is random here, so only the order checks fail.
    failed = {r["check_name"] for r in findings.filter("NOT passed").collect()}
    assert failed == {"time_order_train", "time_order_test"}
    warned = sorted(r["detail"] for r in findings.filter("check_name = 'feature_names'").collect())
    assert warned == ["a_ahead contains ahead", "lead_time contains lead"]
    assert findings.filter("check_name = 'labels'").select("severity").distinct().first()["severity"] in ("ok", "warn")
    overlap = validate.validate_pipeline(labelled, labelled, O)
    assert not validate.all_passed(overlap)


@pytest.mark.parametrize("options", [O, replace(O, group_rows=20)])
def test_unexplained_labels(log, frame, options):
    leaky = log.withColumn(O.target, F.col("failure").cast("int"))
    found = {r["seq"] for r in validate.unexplained_labels(leaky, options).collect()}
    want = set()
    for _, g in brute.ordered(frame).groupby("machine_id"):
        g = g.reset_index(drop=True)
        for i in g.index[g["failure"]]:
            later = g[(g.index > i) & g["failure"] & (g["us"] <= g["us"][i] + 24 * brute.HOUR)]
            if later.empty:
                want.add(g["seq"][i])
    assert found == want and want


def test_features_look_back(log):
    cut = split.time_threshold(log, O)

    def make(df):
        t = Timeline.measure(df, O)
        return features.create_ema_features(features.create_rolling_features(df, O, ["a"], t), O, ["a"], t)

    def peek(df):
        from pyspark.sql import Window

        return df.withColumn("a_next", F.lead("a").over(Window.partitionBy("machine_id").orderBy("timestamp", "seq")))

    assert validate.feature_prefix_mismatches(log, O, make, cut, ["seq"]).count() == 0
    assert validate.feature_prefix_mismatches(log, O, peek, cut, ["seq"]).count() > 0


def test_common_machines(log):
    failed = log.filter("failure")
    assert {r["machine_id"] for r in validate.common_machines(failed, log, O).collect()} == {
        r["machine_id"] for r in failed.select("machine_id").distinct().collect()
    }
    assert validate.bag_union(failed, log).count() == failed.count() + log.count()


def flags(spark, values, kind, options=O):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, failure {kind}")
    flagged = df.withColumn("f", failure_flag(df, "failure", options)).orderBy("i")
    return [r["f"] for r in flagged.collect()]


def test_failure_flag(spark):
    missing = replace(O, missing_is_failure=True)
    assert flags(spark, ["yes", "No", "T", "0", "1"], "string") == [True, False, True, False, True]
    assert flags(spark, ["2", "0", "junk", "yes", "-1.5"], "string") == [True, False, False, False, True]
    assert flags(spark, ["yes", None], "string") == [True, False]
    # As numbers, words count for nothing; a missing cell forces numbers when it counts.
    assert flags(spark, ["yes", "1", None], "string", missing) == [False, True, False]
    assert flags(spark, [0.0, 2.0, None], "double") == [False, True, False]
    assert flags(spark, [0.0, 2.0, None], "double", missing) == [False, True, True]
    assert flags(spark, [True, False, None], "boolean") == [True, False, False]


def test_no_failure_column(spark):
    df = spark.createDataFrame([("a", 0)], "machine_id string, seq long").withColumn("timestamp", F.current_timestamp())
    labelled = create_target(df, O)
    assert labelled.first()[O.target] == 0
    assert target_summary(labelled, O).first()["failures"] == 0
