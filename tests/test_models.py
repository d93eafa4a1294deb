"""Models, search, persistence and attributions."""

import itertools
import math

import numpy as np
import pytest
from gearwatch.operators import attribution, model_tables, models, search
from pyspark.sql import functions as F

NAMES = ["temperature", "pressure[bar]", "vibration_ema_0.3"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)).round(2)
    noise = rng.normal(size=500) * 0.3
    y = (x[:, 0] + x[:, 1] * x[:, 2] + noise > 1.2).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    schema = "seq long, temperature double, `pressure[bar]` double, `vibration_ema_0.3` double, y int"
    return spark.createDataFrame(rows, schema).repartition(3, "seq")


@pytest.fixture(scope="module")
def data(table):
    return models.prepare_training(table, NAMES, "y")


@pytest.fixture(scope="module")
def boosted(data):
    return models.train_boosted(data, maxIter=4, maxDepth=3)


@pytest.fixture(scope="module")
def forest(data):
    return models.train_random_forest(data, numTrees=3, maxDepth=3)


def test_counts_and_weights(data, table):
    positives = table.filter("y = 1").count()
    assert (data.positives, data.negatives) == (positives, 500 - positives)
    assert data.balanced == pytest.approx((500 / 2 / (500 - positives), 500 / 2 / positives))
    assert data.ratio == pytest.approx((500 - positives) / positives)
    with pytest.raises(ValueError):
        models.prepare_training(table.withColumn("y", F.lit(0)), NAMES, "y")


def test_baseline_learns(data, table):
    model = models.train_baseline(data)
    scored = model.predict(table)
    assert scored.filter("probability BETWEEN 0 AND 1").count() == 500
    hits = scored.filter("y = 1").agg(F.avg("prediction")).first()[0]
    assert hits > 0.6
    with pytest.raises(ValueError):
        attribution.with_attributions(scored, model)


def test_alignment(boosted, spark):
    assert boosted.features == ["temperature", "pressure_bar_", "vibration_ema_0.3"]
    df = spark.createDataFrame([(1.0, None)], "`pressure[bar]` double, temperature double")
    row = models.with_values(df, boosted.features).first()
    assert row["values"] == [0.0, 1.0, 0.0]
    assert models.missing_features(df, boosted.features) == ["vibration_ema_0.3"]


def test_save_and_load(boosted, table, tmp_path, spark):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, base=base)
    boosted.save(f"{base}/models_20240101_000000/boosted")
    boosted.save(f"{base}/models_20250101_000000/boosted")
    loaded, folder = models.load_model(spark, "xgboost", base=base)
    assert folder.endswith("models_20250101_000000") and loaded.features == boosted.features
    both = boosted.predict(table).select("seq", "probability").exceptAll(loaded.predict(table).select("seq", "probability"))
    assert both.count() == 0
    with pytest.raises(ValueError):
        models.load_model(spark, "svm", base=base)
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, "baseline", base=base)


def test_importance(boosted, spark):
    gains = [r["importance"] for r in models.feature_importance(spark, boosted).collect()]
    assert gains == sorted(gains, reverse=True) and sum(gains) == pytest.approx(1.0)


def test_draws():
    grid = {"a": [1, 2, 3], "b": [4, 5]}
    assert len(search.draw_settings(grid, 50)) == 6
    drawn = search.draw_settings(search.BOOSTED_GRID, 50)
    assert len({tuple(d.items()) for d in drawn}) == 50
    assert drawn == search.draw_settings(search.BOOSTED_GRID, 50)


@pytest.mark.parametrize(
    "kind,grid",
    [
        ("random_forest", {"numTrees": [3], "maxDepth": [1, 4], "positive_weight": ["balanced", 10.0]}),
        ("boosted", {"maxIter": [2], "maxDepth": [1, 3], "positive_weight": [1.0]}),
    ],
)
def test_search(data, table, kind, grid):
    model, scores = search.search(kind, data, ["seq"], grid, draws=9, folds=2)
    assert len(scores) == math.prod(map(len, grid.values()))
    best = max(s for _, s in scores)
    assert dict(model.params) in [p for p, s in scores if s == best]
    assert model.predict(table).count() == 500


def brute_force(model, x):
    """Shapley values by all coalitions, with cover-weighted tree descent."""
    nodes, weights, forest = attribution.ensemble_nodes(model)
    rows = nodes.collect()
    trees = [{r["id"]: r for r in rows if r["treeID"] == t} for t in range(len(weights))]

    def cover(n):
        return sum(n["impurityStats"]) if forest else n["rawCount"]

    def descend(tree, n, known):
        if n["leftChild"] < 0:
            s = n["impurityStats"]
            return s[1] / sum(s) if forest else n["prediction"]
        f, at = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
        left, right = tree[n["leftChild"]], tree[n["rightChild"]]
        if f in known:
            return descend(tree, left if x[f] <= at else right, known)
        a, b = cover(left), cover(right)
        return (a * descend(tree, left, known) + b * descend(tree, right, known)) / (a + b)

    def value(known):
        return sum(w * descend(t, t[0], known) for w, t in zip(weights, trees))

    k = len(x)
    phi = [0.0] * k
    for f in range(k):
        others = [g for g in range(k) if g != f]
        for size in range(k):
            for s in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k)
                phi[f] += w * (value({*s, f}) - value(set(s)))
    return value(set()), phi


@pytest.mark.parametrize("kind", ["boosted", "forest"])
@pytest.mark.parametrize("way", ["whole", "blocks", "grouped"])
def test_attributions(kind, way, boosted, forest, table, monkeypatch):
    if way == "blocks":
        monkeypatch.setattr(attribution, "ROWS_AT_ONCE", 7)
        monkeypatch.setattr(attribution, "CELLS_AT_ONCE", 1)
    if way == "grouped":
        monkeypatch.setattr(attribution, "BROADCAST_BYTES", 1)
    model = {"boosted": boosted, "forest": forest}[kind]
    if way == "grouped":
        nodes, weights, of_forest = attribution.ensemble_nodes(model)
        assert len(attribution.tree_groups(attribution.node_table(nodes), weights, of_forest)) > 1
    explained = attribution.with_attributions(model.predict(table), model)
    check = attribution.additivity(explained, model).first()
    assert check["is_valid"] and check["max_error"] < 1e-9 and check["some_importance"]
    for r in explained.orderBy("seq").limit(3).collect():
        base, phi = brute_force(model, r["values"])
        assert r["base"] == pytest.approx(base, abs=1e-12)
        assert r["attributions"] == pytest.approx(phi, abs=1e-12)


def test_points(boosted, table):
    df = attribution.with_attributions(boosted.predict(table), boosted)
    importance = attribution.attribution_importance(df, boosted.features).collect()
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
    assert attribution.summary_points(df, boosted.features, ["seq"], 2).count() == 1000
    steps = attribution.waterfall_points(df.filter("seq = 7"), boosted.features, ["seq"]).orderBy("position").collect()
    margin = df.filter("seq = 7").first()["margin"]
    assert steps[-1]["score_after"] == pytest.approx(margin, abs=1e-9)
    assert attribution.dependence_points(df, boosted.features, "temperature", ["seq"]).count() == 500


def test_sample_ignores_partitioning(table):
    pick = lambda df: {r["seq"] for r in attribution.background_sample(df, ["seq"], 20).collect()}
    assert pick(table) == pick(table.repartition(7)) and len(pick(table)) == 20


def test_many_training_rows_are_dealt_out(data, monkeypatch):
    """However few files hold them, no task learns from more than its rows."""
    seen = []
    monkeypatch.setattr(models, "TASK_ROWS", 20)
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    one_task = models.TrainingSet(data.df.coalesce(1), data.features, data.negatives, data.positives)
    model = models.train_boosted(one_task, maxIter=2, maxDepth=2)
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert seen[0].rdd.getNumPartitions() >= 25 and sum(sizes) == 500 and max(sizes) <= 50
    assert model.predict(data.df).where("prediction = 1").count() > 0


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_scores_by_join_keep_rows_whole(request, table, kind):
    """Scores from leaf intervals, without a line per row, feature and leaf on the way."""
    model = request.getfixturevalue(kind)
    intervals = model_tables.leaf_intervals(model)
    again = model_tables.scores_by_join(table, model, intervals, ["seq"])
    plan = again._jdf.queryExecution().toString()
    assert "inline" not in plan
    score = "margin" if kind == "boosted" else "probability"
    both = model.predict(table).select("seq", score).join(again, "seq").collect()
    assert len(both) == 500 and all(r["score"] == pytest.approx(r[score], abs=1e-9) for r in both)
    twice = table.unionByName(table.where("seq < 10"))
    assert model_tables.scores_by_join(twice, model, intervals, ["seq"]).count() == 490
