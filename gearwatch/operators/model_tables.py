"""Tree ensembles as tables: nodes and leaf intervals out of a model, a model out of nodes.

A leaf is reached by the rows whose feature values lie in its intervals, one per feature on its
path. The table of intervals says what a model does without any model code, so predictions can be
checked, or made, by a join.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.operators.attribution import ensemble_nodes
from gearwatch.operators.models import FailureModel, boosted_estimator, forest_estimator, with_values
from gearwatch.session import fresh_path, written

NODES = (
    "treeID int, id int, prediction double, gain double, rows long, stats array<double>, "
    "leftChild int, rightChild int, feature int, threshold double"
)


def model_from_nodes(spark: SparkSession, nodes: DataFrame, kind: str, features: list[str], step: float = 0.1) -> FailureModel:
    """A model whose trees are given as rows of ``NODES``; leaves have children and feature -1.

    ``stats`` are rows per class in a forest. In a boosted model the first tree weighs 1, the others
    ``step``. The trees of a small fitted model are replaced in its saved form.
    """
    trees = nodes.agg(F.max("treeID")).first()[0] + 1
    few = spark.createDataFrame([(Vectors.dense([float(i)] * len(features)), float(i % 2), 1.0) for i in range(4)], ["features", "label", "weight"])
    if kind == "boosted":
        fitted = boosted_estimator(maxIter=trees, maxDepth=1, stepSize=step, subsamplingRate=1.0, featureSubsetStrategy="all").fit(few)
    else:
        fitted = forest_estimator(numTrees=trees, maxDepth=1).fit(few)
    path = fresh_path(spark, "model")
    fitted.write().save(path)
    kept = spark.read.parquet(f"{path}/data").schema
    inner = kept["nodeData"].dataType
    leaf = F.col("leftChild") < 0
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    known = {
        "id": F.col("id"), "prediction": F.col("prediction"), "impurity": F.lit(0.0), "impurityStats": F.col("stats"),
        "rawCount": F.col("rows"), "gain": F.when(leaf, F.lit(-1.0)).otherwise(F.col("gain")),
        "leftChild": F.col("leftChild"), "rightChild": F.col("rightChild"), "split": split,
    }
    data = F.struct(*[known[f.name].cast(f.dataType).alias(f.name) for f in inner.fields])
    nodes.select("treeID", data.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    loader = GBTClassificationModel if kind == "boosted" else RandomForestClassificationModel
    return FailureModel(kind, features, PipelineModel([loader.load(path)]), {"trees": trees})


def leaf_intervals(model: FailureModel) -> DataFrame:
    """(tree, leaf, worth, conditions, feature, low, high): a row per leaf and feature on its path.

    ``worth`` is what the leaf adds to the raw score, ``conditions`` the number of its features; a
    row meets a condition if low < x <= high. A lone leaf has one condition that every row meets.
    """
    spark = SparkSession.getActiveSession()
    nodes, weights, forest = ensemble_nodes(model)
    stats = F.col("impurityStats")
    value = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if forest else F.col("prediction")
    weight = spark.createDataFrame(list(enumerate(map(float, weights))), "treeID int, weight double")
    nodes = written(nodes.join(F.broadcast(weight), "treeID"), "nodes")  # one number per tree
    below = nodes.where("leftChild >= 0").select(
        "treeID", F.col("split.featureIndex").alias("f"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("at"),
        F.col("id").alias("parent"), "leftChild", "rightChild",
    )
    everything = F.struct(F.lit(None).cast("int").alias("f"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
    level = nodes.where("id = 0").select("treeID", "id", F.filter(F.array(everything), lambda x: F.lit(False)).alias("path"))
    found: DataFrame | None = None
    # A join per level: nodes find their children, at most thirty times.
    while True:
        met = level.join(nodes, ["treeID", "id"])
        ends = met.where("leftChild < 0").select("treeID", "id", (F.col("weight") * value).alias("worth"), "path")
        found = ends if found is None else found.unionByName(ends)
        inner = level.join(below.withColumnRenamed("parent", "id"), ["treeID", "id"])
        side = lambda child, low, high: F.struct(
            F.col(child).alias("id"),
            F.concat("path", F.array(F.struct(F.col("f"), low.alias("low"), high.alias("high")))).alias("path"),
        )
        sides = F.array(
            side("leftChild", F.lit(float("-inf")), F.col("at")), side("rightChild", F.col("at"), F.lit(float("inf")))
        )
        level = written(inner.select("treeID", F.explode(sides).alias("s")).select("treeID", "s.id", "s.path"), "level")
        if level.isEmpty():
            break
    names = F.array(*map(F.lit, model.features))
    each = found.select("treeID", "id", "worth", F.explode_outer("path").alias("c"))
    cut = each.groupBy("treeID", "id", "worth", F.col("c.f").alias("f")).agg(
        F.coalesce(F.max("c.low"), F.lit(float("-inf"))).alias("low"), F.coalesce(F.min("c.high"), F.lit(float("inf"))).alias("high")
    )
    sizes = cut.groupBy("treeID", "id").agg(F.count("*").alias("conditions"))
    return cut.join(sizes, ["treeID", "id"]).select(
        F.col("treeID").alias("tree"), F.col("id").alias("leaf"), "worth", "conditions",
        F.coalesce(F.get(names, F.col("f")), F.lit(model.features[0])).alias("feature"), "low", "high",
    )


def scores_by_join(df: DataFrame, model: FailureModel, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, score): the raw score of each row from the table of leaf intervals.

    A second way to predictions, for checks: rows meet the leaves all of whose intervals they lie
    in, and a leaf that is met adds its worth. ``keys`` tell rows apart; rows that share them have
    no score. Intervals are gathered to one line per leaf, which every task gets; a row leaves its
    task with the few leaves it meets, one per tree. Each row is held against each leaf, so this is
    no way to score a log with a large model.
    """
    rows = with_values(df, model.features).select(*keys, "values")
    place = F.array_position(F.array(*map(F.lit, model.features)), F.col("feature")).cast("int") - 1
    condition = F.struct(place.alias("place"), "low", "high")
    leaves = intervals.groupBy("tree", "leaf", "worth").agg(F.collect_list(condition).alias("path"))
    x = lambda c: F.get("values", c["place"])
    met = F.forall("path", lambda c: (x(c) > c["low"]) & (x(c) <= c["high"]))
    scored = rows.join(F.broadcast(leaves), met).groupBy(*keys).agg(F.sum("worth").alias("score"), F.count("*").alias("met"))
    return scored.where(F.col("met") <= model.classifier.getNumTrees).drop("met")
