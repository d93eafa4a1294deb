"""Inputs the given tables do not hold: missing times, bursts, huge counts, other data under one address."""

import itertools
import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from gearwatch.operators import attribution, features, metrics, scoring, split, target, validate
from gearwatch.operators.timeline import SEG, Timeline
from gearwatch.options import LogOptions
from gearwatch.plans.explanation_job import explain
from gearwatch.sources import sensor_log
from pyspark.sql import functions as F

OPTIONS = LogOptions()
SCHEMA = "machine_id string, us long, seq long, x double, failure boolean"


def log(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("timestamp", F.timestamp_micros("us")).drop("us")


@pytest.fixture(scope="module")
def untimed(spark):
    rng = np.random.default_rng(1)
    rows = []
    for m in ("a", "b", None):
        for i in range(60):
            us = None if i % 7 == 3 else int(rng.integers(0, 40)) * 3_600_000_000
            rows.append((m, us, len(rows), float(rng.normal()), bool(i % 11 == 5)))
    return log(spark, rows)


@pytest.mark.parametrize(
    "make",
    [
        lambda df, o: features.create_lag_features(df, o, ["x"]),
        lambda df, o: features.create_ema_features(df, o, ["x"], filled=True),
        lambda df, o: target.create_target(df, o),
    ],
)
def test_missing_times_cut_and_uncut(untimed, make):
    whole, cut = (
        sorted(make(untimed, o).drop("timestamp").collect(), key=lambda r: r["seq"])
        for o in (OPTIONS, replace(OPTIONS, group_rows=5))
    )
    for a, b in zip(whole, cut):
        for c in a.asDict():
            assert a[c] == b[c] or a[c] == pytest.approx(b[c], abs=1e-9), (c, a, b)


def test_missing_times_come_last(spark):
    df = log(spark, [("m", 10, 0, 1.0, False), ("m", None, 1, 5.0, False), ("m", 5, 2, 3.0, False)])
    made = features.create_lag_features(df, OPTIONS, ["x"]).collect()
    assert {r["seq"]: r["x_lag_1"] for r in made} == {2: None, 0: 3.0, 1: 1.0}


@pytest.mark.parametrize("burst_us", [1, 7919])
def test_bursts_make_few_segments(spark, burst_us):
    # Half of the readings fall into one burst, the others are far apart.
    n, limit = 20_000, 1_000
    df = spark.range(n).select(
        F.lit("m").alias("machine_id"),
        F.when(F.col("id") % 2 == 0, F.col("id") * 60_000_000)
        .otherwise(F.lit(7_000_000_000) + (F.col("id") * burst_us) % 20_000).alias("us"),
        F.col("id").alias("seq"), F.col("id").cast("double").alias("x"), F.lit(False).alias("failure"),
    ).withColumn("timestamp", F.timestamp_micros("us"))
    options = replace(OPTIONS, group_rows=limit)
    sizes = [r["count"] for r in Timeline.measure(df, options).attach(df).groupBy(SEG).count().collect()]
    assert len(sizes) <= 2 * n / limit + 5
    assert max(sizes) <= 2 * limit
    made = features.create_lag_features(df, options, ["x"])
    want = features.create_lag_features(df, OPTIONS, ["x"])
    assert made.exceptAll(want.select(*made.columns)).count() == 0


def test_area_of_large_logs(spark):
    sums = spark.createDataFrame([(5e21, 10**10, 10**12)], "wins double, p long, n long")
    assert sums.select(metrics.area_of("wins", "p", "n").alias("a")).first()["a"] == pytest.approx(0.5)


def test_area_with_missing_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None)], "label int, probability double")
    assert metrics.roc_auc(df).first()["roc_auc"] == 0.0
    assert metrics.roc_auc(df.dropna()).first()["roc_auc"] == 1.0


@pytest.mark.parametrize("test_size", [0.0, 0.5, 1.0])
def test_untimed_rows_are_on_no_side(spark, test_size):
    df = log(spark, [("m", 1, 1, 0.0, False), ("m", None, 2, 0.0, False), ("m", 3, 3, 0.0, False), ("m", 4, 4, 0.0, False)])
    train, test = split.time_based_split(df, replace(OPTIONS, test_size=test_size))
    assert {r["seq"] for r in train.collect()} | {r["seq"] for r in test.collect()} == {1, 3, 4}
    if test_size == 0:
        assert test.count() == 0


def test_quoted_cells(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('machine_id,timestamp,note,x\nm,2024-01-01 00:00:00,"say ""hi"", ok",1\nm,2024-01-01 01:00:00,plain,2.5\n')
    rows = sensor_log.read_csv_log(spark, str(path), OPTIONS).orderBy("timestamp").collect()
    assert [(r["note"], r["x"]) for r in rows] == [('say "hi", ok', 1.0), ("plain", 2.5)]


def test_nanosecond_clocks_are_exact(spark):
    stamps = [1_700_000_000_000_000_000 + i * 1_000_003 for i in range(1000)] + [-1, -1000, 999]
    df = spark.createDataFrame([(s,) for s in stamps], "timestamp long")
    made = sensor_log.with_time(df, OPTIONS).select(F.unix_micros("timestamp").alias("us")).collect()
    assert [r["us"] for r in made] == [s // 1000 for s in stamps]


def test_other_rows_under_one_address(spark, tmp_path):
    with pytest.raises(ValueError):
        explain(None, None, OPTIONS, str(tmp_path), "v1")


def test_reasons_without_explanations(spark):
    class Model:
        kind, features = "baseline", ["temperature"]

        @staticmethod
        def predict(df):
            return df.withColumn("probability", F.col("temperature") / 100)

    df = spark.createDataFrame([(90.0, 2.0, 0.1), (50.0, 2.0, 0.1)], "temperature double, pressure double, vibration double")
    got = scoring.score_requests(df, Model()).orderBy("temperature").collect()
    assert got[0]["top_risk_factors"] == []
    assert got[1]["top_risk_factors"] == ["High temperature", "Pressure instability", "Vibration trend"]


def test_label_check_in_the_report(spark):
    hour = 3_600_000_000
    rows = [("a", i * hour, i, 1.0, i in (3, 5)) for i in range(10)]
    made = target.create_target(log(spark, rows), OPTIONS).withColumn(
        OPTIONS.target, F.when(F.col("seq") == 5, 1).otherwise(F.col(OPTIONS.target))
    )
    later = log(spark, [("a", 100 * hour, 100, 1.0, False)]).withColumn(OPTIONS.target, F.lit(0))
    found = validate.validate_pipeline(made, later, OPTIONS, ["x"]).collect()
    assert [r["severity"] for r in found if r["check_name"] == "labels"] == ["warn"]
    assert {r["severity"] for r in found if r["check_name"] != "labels"} == {"ok"}


def test_deep_paths_add_up():
    """Leaves of one deep path against the definition by coalitions of the last feature only."""
    rng = np.random.default_rng(0)
    k = 30
    share = rng.uniform(0.2, 0.9, (1, k))
    steps = [(i, -1, i, -np.inf, 0.0, share[0, i], 2.0 * (i == k - 1), i + 1) for i in range(k)]
    base, leaf = attribution._tree([(-1, -1, -1, -np.inf, np.inf, 1.0, 0.0, 0), *steps])
    x = rng.normal(size=(5, k))
    phi = attribution.explain_batch(x, [leaf])
    assert base == pytest.approx(2.0 * share.prod())
    admitted = (x <= 0).all(axis=1)
    assert phi.sum(axis=1) == pytest.approx(2.0 * admitted - 2.0 * share.prod(), abs=1e-12)


def test_features_split_again_and_again(monkeypatch):
    """A tree of depth nine over four features, leaf by leaf and coalition by coalition."""
    rng = np.random.default_rng(2)
    rows, paths = [], []

    def grow(path, weight):
        at, depth = len(rows), sum(len(p[3]) for p in path.values())
        rows.append(None)
        if depth == 9 or (depth > 2 and rng.random() < 0.1):
            value = float(rng.normal())
            rows[at] = (0, at, value, weight, [0.0, 0.0], -1, -1, -1, 0.0)
            paths.append((value, path))
            return at
        f, t = int(rng.integers(4)), float(rng.normal())
        low, high, share, cuts = path.get(f, (-np.inf, np.inf, 1.0, ()))
        left = int(rng.integers(1, 1000))
        right = int(rng.integers(1, 1000))
        a = grow({**path, f: (low, min(high, t), share * left / (left + right), (*cuts, t))}, left)
        b = grow({**path, f: (max(low, t), high, share * right / (left + right), (*cuts, t))}, right)
        rows[at] = (0, at, 0.0, weight, [0.0, 0.0], a, b, f, t)
        return at

    grow({}, 1000)
    nodes = pd.DataFrame(rows, columns=["treeID", "id", "prediction", "rawCount", "stats", "leftChild", "rightChild", "feature", "threshold"])
    x = rng.normal(size=(6, 4))

    def worth(row, known):
        return sum(v * np.prod([(low < row[f] <= high) if f in known else share for f, (low, high, share, _) in p.items()]) for v, p in paths)

    want = np.zeros((6, 4))
    for r, f in itertools.product(range(6), range(4)):
        others = [g for g in range(4) if g != f]
        for size in range(4):
            for some in itertools.combinations(others, size):
                share = math.factorial(size) * math.factorial(3 - size) / 24
                want[r, f] += share * (worth(x[r], {*some, f}) - worth(x[r], set(some)))
    for bound in (64 << 20, 2000, 1):
        monkeypatch.setattr(attribution, "BROADCAST_BYTES", bound)
        parts = list(attribution._parts(nodes, 1.0, forest=False))
        assert len(parts) == (1 if bound > 2000 else len(paths) if bound == 1 else len(parts))
        assert sum(b for b, _ in parts) == pytest.approx(worth(None, set()), abs=1e-12)
        assert attribution.explain_batch(x, [t for _, t in parts]) == pytest.approx(want, abs=1e-12)
