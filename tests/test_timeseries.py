"""Cleaning, features and target against plain loops, on whole and on cut machines."""

import re
from dataclasses import replace

import brute
import numpy as np
import pytest
from gearwatch.functions.columns import without_nan
from gearwatch.operators import clean, features, target, timeline
from gearwatch.operators.timeline import Timeline
from gearwatch.options import LogOptions
from pyspark.sql import functions as F

BASE = LogOptions(alphas=(0.05, 0.3, 0.7, 1.0), lags=(1, 2, 3))
SHAPES = {
    "whole": BASE,
    "cut": replace(BASE, group_rows=20),
    "dense": replace(BASE, dense_rows=1),
    "dense_cut": replace(BASE, dense_rows=1, group_rows=5),
}


def to_spark(spark, frame):
    return without_nan(spark.createDataFrame(frame)).repartition(5)


def back(df, options=BASE):
    frame = df.toPandas().sort_values(["machine_id", "timestamp", "seq"]).reset_index(drop=True)
    return frame


def same(got, want, tol=1e-9):
    got = np.array([np.nan if v is None else v for v in got], dtype=float)
    want = np.array(want, dtype=float)
    assert (np.isnan(got) == np.isnan(want)).all()
    np.testing.assert_allclose(got, want, rtol=tol, atol=tol, equal_nan=True)


@pytest.fixture(params=[0, 1])
def frame(request):
    return brute.random_log(request.param, ties=request.param == 0, hot=0.6)


@pytest.mark.parametrize("shape", ["whole", "cut"])
@pytest.mark.parametrize("method", ["time", "linear", "forward"])
def test_interpolation(spark, frame, shape, method):
    o = SHAPES[shape]
    df = to_spark(spark, frame)
    t = Timeline.measure(df, o)
    assert t.split == ("cut" in shape)
    got = back(clean.interpolate_missing_values(df, o, ["a", "b"], method, t))
    want = brute.ordered(frame)
    for c in ("a", "b"):
        same(got[c], brute.per_machine(want, lambda g: brute.fill(g, c, method)))


@pytest.mark.parametrize("shape", SHAPES)
def test_features_and_target(spark, frame, shape):
    o = SHAPES[shape]
    filled = frame.copy()
    want = brute.ordered(frame)
    for c in ("a", "b"):
        want[c] = brute.per_machine(want, lambda g: brute.fill(g, c))
    filled = want.drop(columns="us")
    df = to_spark(spark, filled)
    got = back(features.feature_pipeline(df, o))
    want = brute.ordered(filled)
    for c in ("a", "b"):
        for k in o.lags:
            same(got[f"{c}_lag_{k}"], brute.per_machine(want, lambda g: brute.lag(g, c, k)))
        for a in o.alphas:
            same(got[f"{c}_ema_{a}"], brute.per_machine(want, lambda g: brute.ema(g, c, a)))
        for name, width in o.windows_us:
            for what in ("mean", "std"):
                same(
                    got[f"{c}_rolling_{what}_{name}"],
                    brute.per_machine(want, lambda g: brute.rolling(g, c, width, what)),
                    1e-8,
                )
    same(got[o.target], brute.per_machine(want, lambda g: brute.target(g, 24)))


@pytest.mark.parametrize("shape", ["whole", "dense_cut"])
def test_rolling_skips_nulls(spark, frame, shape):
    o = SHAPES[shape]
    got = back(features.create_rolling_features(to_spark(spark, frame), o))
    want = brute.ordered(frame)
    for name, width in o.windows_us:
        for what in ("mean", "std"):
            same(
                got[f"a_rolling_{what}_{name}"],
                brute.per_machine(want, lambda g: brute.rolling(g, "a", width, what)),
                1e-8,
            )


@pytest.mark.parametrize("shape", ["whole", "cut"])
def test_ema_over_gaps(spark, frame, shape):
    o = replace(SHAPES[shape], alphas=(0.3, 0.7, 1.0))
    got = back(features.create_ema_features(to_spark(spark, frame), o))
    want = brute.ordered(frame)
    for c in ("a", "b"):
        for a in o.alphas:
            same(got[f"{c}_ema_{a}"], brute.per_machine(want, lambda g: brute.ema_with_gaps(g, c, a)))


def test_target_two_ways(spark, frame):
    o = replace(BASE, horizon_hours=6)
    df = to_spark(spark, frame)
    positives = back(target.target_by_join(df, o))
    labelled = back(target.create_target(df, o))
    many = labelled.groupby("machine_id")["seq"].transform("size") > 1
    assert sorted(positives["seq"]) == sorted(labelled[many & (labelled[o.target] == 1)]["seq"])


def test_window_and_horizon_edges(spark):
    rows = [("M", f"2024-01-01 {h:02d}:00:00", i, float(i), 0.0, False) for i, h in enumerate((0, 1, 4, 8))]
    rows.append(("M", "2024-01-02 00:00:00", 9, 9.0, 0.0, True))
    df = spark.createDataFrame(rows, "machine_id string, timestamp string, seq long, a double, b double, failure boolean")
    df = df.withColumn("timestamp", df.timestamp.cast("timestamp"))
    for o in SHAPES.values():
        got = back(features.feature_pipeline(df, o, ["a"]))
        # A reading exactly one window back is outside.
        assert got["a_rolling_mean_1h"].tolist() == [0.0, 1.0, 2.0, 3.0, 9.0]
        assert got["a_rolling_mean_8h"].tolist() == [0.0, 0.5, 1.0, 2.0, 9.0]
        # Exactly 24 h ahead counts, the same instant does not.
        assert got[o.target].tolist() == [1, 1, 1, 1, 0]


def test_few_scans_and_exchanges_however_machines_are_cut(spark, tmp_path):
    """Cleaning and all features: the log is read once by crowded and once by calm machines, beside small tables of states."""
    frame = brute.random_log(0, hot=0.6)
    to_spark(spark, frame).write.parquet(str(tmp_path / "log"))
    log, o = spark.read.parquet(str(tmp_path / "log")), SHAPES["dense_cut"]
    t = Timeline.measure(log, o)
    assert t.split and not t.sparse
    made = features.feature_pipeline(clean.clean_pipeline(log, o, timeline=t), o, timeline=t, filled=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Final Plan")[-1]
    assert plan.count(f"{tmp_path}/log") <= 2
    assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|round|Single)", plan)) <= 10


def test_panes_narrow_down_to_one_instant(spark):
    """Bursts of unlike density: no pane holds more rows than a group may, except those of one microsecond."""
    rng = np.random.default_rng(3)
    start = 1_700_000_000_000_000
    us = [*rng.integers(0, 3 * brute.HOUR, 40), *(brute.HOUR + rng.integers(0, 90, 150)), *[2 * brute.HOUR] * 30, *(-rng.integers(1, 50, 20))]
    rows = [("M", int(start + u), i, float(rng.normal()), None, False) for i, u in enumerate(us)]
    df = spark.createDataFrame(rows, "machine_id string, us long, seq long, a double, b double, failure boolean")
    df = df.withColumn("timestamp", F.timestamp_micros("us")).drop("us")
    o = replace(BASE, dense_rows=1, group_rows=10, windows=(("1h", 3600), ("1h1s", 3601)))
    shift, narrow = features.pane_shifts(df, o)
    own = dict(narrow)["M"]
    panes = df.groupBy(F.shiftright(F.unix_micros("timestamp"), own)).agg(F.count("*").alias("n"), F.countDistinct("timestamp").alias("k"))
    assert own < shift and panes.where("n > 10 AND k > 1").count() == 0
    got = back(features.create_rolling_features(df, o, ["a"]))
    want = brute.ordered(got[["machine_id", "timestamp", "seq", "a", "failure"]])
    for name, width in o.windows_us:
        for what in ("mean", "std"):
            same(got[f"a_rolling_{what}_{name}"], brute.per_machine(want, lambda g: brute.rolling(g, "a", width, what)), 1e-8)


def test_sums_of_many_panes_are_not_broadcast(spark):
    """Rows made of panes are many times the table of panes, by whose size Spark would judge them."""
    log = spark.range(0, 2000, 1, 4).selectExpr(
        "'M' AS machine_id", "timestamp_micros(id * 3600000000) AS timestamp", "id AS seq", "id * 0.5D AS a", "false AS failure"
    )
    made = features.create_rolling_features(log, replace(BASE, dense_rows=0), ["a"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert made.where("seq = 1999").first()["a_rolling_mean_4h"] == pytest.approx(0.5 * (1999 - 1.5))


def test_rows_of_crowded_machines_move_once(spark):
    """Beyond a few rows no sums of panes are dealt out beside the rows, and no table of them is written."""
    log = spark.range(0, 60_000, 1, 4).selectExpr(
        "concat('M', id % 20) AS machine_id", "timestamp_micros(id div 20 * 3600000000) AS timestamp", "id AS seq", "id * 0.5D AS a", "false AS failure"
    )
    made = features.create_rolling_features(log, replace(BASE, dense_rows=0), ["a"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange ", plan)) == 1 and "Join" not in plan and "/panes-" not in plan
    last = made.where("seq = 59999").first()
    assert last["a_rolling_mean_4h"] == pytest.approx(0.5 * (59999 - 30)) and made.count() == 60_000


# Wide panes, and beside cut machines those that are not cut; windows that are multiples of nothing.
WIDE = {
    "wide": replace(BASE, dense_rows=0, windows=(("1h", 3600), ("1h1s", 3601), ("8h", 28800))),
    "some_crowded": replace(BASE, dense_rows=12),
    "some_cut": replace(BASE, dense_rows=0, group_rows=100),
    "some_cut_some_crowded": replace(BASE, dense_rows=6, group_rows=100),
}


@pytest.mark.parametrize("shape", WIDE)
def test_wide_panes(spark, monkeypatch, shape):
    """Rows before 1970, gaps, ties, a machine without a name: as plain loops say."""
    monkeypatch.setattr(features, "FEW_ROWS", 0)
    o, frame = WIDE[shape], brute.random_log(0, hot=0.6)
    frame["timestamp"] -= frame["timestamp"].min() + np.timedelta64(36, "h") - np.datetime64("1970-01-01")
    df = to_spark(spark, frame).withColumn("machine_id", F.nullif("machine_id", F.lit("M2")))
    t = Timeline.measure(df, o)
    assert t.split == ("cut" in shape) and not t.sparse and len(t.cut) == t.split
    got = features.create_rolling_features(df, o, ["a"], t)
    assert "explode([0,1])" in got._jdf.queryExecution().executedPlan().toString()
    got = back(got.fillna("M2", ["machine_id"]))
    want = brute.ordered(frame)
    assert len(got) == len(want)
    for name, width in o.windows_us:
        for what in ("mean", "std"):
            same(got[f"a_rolling_{what}_{name}"], brute.per_machine(want, lambda g: brute.rolling(g, "a", width, what)), 1e-8)


@pytest.mark.parametrize("shape", ["whole", "cut"])
def test_tasks_grow_in_number_with_the_rows(spark, monkeypatch, shape):
    """Rows are dealt out by their number, not by the bytes of a shuffle."""
    log, o = to_spark(spark, brute.random_log(0, hot=0.6)), SHAPES[shape]
    want = back(features.create_ema_features(log, o, ["a"]))
    rows, cores = log.count(), spark.sparkContext.defaultParallelism
    monkeypatch.setattr(timeline, "TASK_ROWS", rows // (2 * cores))
    made = features.create_ema_features(log, o, ["a"])
    assert "REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString()
    for a in o.alphas:
        same(back(made)[f"a_ema_{a}"], want[f"a_ema_{a}"])


@pytest.mark.parametrize("shape", ["whole", "cut"])
@pytest.mark.parametrize("gaps", [False, True])
def test_averages_forget_nothing(spark, shape, gaps):
    """Blocks of a few rows, and readings so large that they show through many of them."""
    rng = np.random.default_rng(4)
    rows = [("M", i * 60_000_000, i, 1e200 if i == 3 else 1e-150 if i == 200 else float(rng.normal(5, 1)), False) for i in range(400)]
    if gaps:
        rows = [(m, u, i, None if rng.random() < 0.3 and i != 3 else x, f) for m, u, i, x, f in rows]
    df = spark.createDataFrame(rows, "machine_id string, us long, seq long, a double, failure boolean")
    df = df.withColumn("timestamp", F.timestamp_micros("us")).drop("us")
    o = replace(SHAPES[shape], alphas=(0.01, 0.5, 0.97), group_rows=40 if shape == "cut" else 1_000_000)
    # Blocks of few rows, several of which a reading must show through.
    got = back(features.create_ema_features(df, o, ["a"]))
    want = brute.ordered(got[["machine_id", "timestamp", "seq", "a", "failure"]])
    for a in o.alphas:
        fold = brute.per_machine(want, lambda g: (brute.ema_with_gaps if gaps else brute.ema)(g, "a", a))
        np.testing.assert_allclose(got[f"a_ema_{a}"].astype(float), fold, rtol=1e-9)
