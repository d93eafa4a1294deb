"""Exact Shapley attributions of tree ensembles, path-dependent, for every row.

For one leaf, the features on its path either admit the row (o = 1) or not (o = 0), and a feature
left out of a coalition passes the share z of training weight that went down the path. The value
a leaf adds to a coalition is then v * prod(o or z). The Shapley weights of coalition sizes are
beta integrals, so the value of feature f is

    v * (o_f - z_f) * integral over t from 0 to 1 of prod over g != f of (z_g (1 - t) + o_g t),

a polynomial that a few Gauss points integrate exactly. Leaves share the factors of their common
path: values of the product at the points go down the tree, sums over leaves come up, and what a
node's feature adds is the sum below it without its factor, less the leaves below where the
feature is split again. A tree costs its nodes times the points, whatever its depth. Rows stay in
Spark; one Arrow column of feature values goes into the helper and one comes out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.functions.columns import logistic, named
from gearwatch.operators.models import FailureModel, with_values
from gearwatch.options import SEED
from gearwatch.session import fresh_path

# Executors get this helper with the task, not from an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tree data shipped to executors at once; larger ensembles go in groups, larger trees in parts.
BROADCAST_BYTES = 64 << 20
# Trees fetched at once; rows, and products of rows, nodes and points, worked on at once.
TREES_AT_ONCE, ROWS_AT_ONCE, CELLS_AT_ONCE = 8, 512, 1 << 21
# Stands for a share of 0, by which nothing can be divided.
TINY = 1e-300
# Bytes of a node in the arrays of ``Tree``.
NODE_BYTES = 48


@dataclass
class Tree:
    """Nodes below the root (number 0) of a tree, or of a part of its leaves, level by level."""

    parent: np.ndarray  # children of a node are side by side
    before: np.ndarray  # nearest node above that was reached by the same feature, -1 if none
    feature: np.ndarray  # by which the node was reached
    low: np.ndarray  # rows with low < x <= high are admitted, by all splits on the feature so far
    high: np.ndarray
    share: np.ndarray  # of training weight that all splits on the feature so far pass
    value: np.ndarray  # 0 at inner nodes
    levels: np.ndarray  # number of nodes up to each level
    depth: int  # most features on one path


def ensemble_nodes(model: FailureModel) -> tuple[DataFrame, list[float], bool]:
    """Node table, tree weights, and whether leaf values are class-1 shares (a forest)."""
    spark = SparkSession.getActiveSession()
    inner = model.classifier
    path = fresh_path(spark, "ensemble")
    inner.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    forest = model.kind == "random_forest"
    weights = [1.0 / inner.getNumTrees] * inner.getNumTrees if forest else list(inner.treeWeights)
    return nodes, weights, forest


def node_table(nodes: DataFrame) -> DataFrame:
    """Columns of a saved ensemble that attributions need, one row per node."""
    return nodes.select(
        "treeID",
        "id",
        "prediction",
        "rawCount",
        F.col("impurityStats").alias("stats"),
        "leftChild",
        "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
    )


def tree_groups(rows: DataFrame, weights: list[float], forest: bool) -> list[tuple[float, list[Tree]]]:
    """(base value, trees) per group of trees; a group fits one broadcast.

    Trees grow with the data when their depth is not limited. They come to the driver a few at
    a time, where Spark keeps a fitted model anyway; a tree beyond the bound is cut into parts, each
    with some of its leaves.
    """
    groups, pending, base, size = [], [], 0.0, 0
    for first in range(0, len(weights), TREES_AT_ONCE):
        some = rows.filter(F.col("treeID").between(first, first + TREES_AT_ONCE - 1)).toPandas()
        for number, nodes in some.groupby("treeID", sort=True):
            for own, part in _parts(nodes, weights[number], forest):
                own_size = NODE_BYTES * len(part.parent)
                if pending and size + own_size > BROADCAST_BYTES:
                    groups.append((base, pending))
                    pending, base, size = [], 0.0, 0
                pending.append(part)
                base, size = base + own, size + own_size
    groups.append((base, pending))
    return groups


def _parts(nodes: pd.DataFrame, weight: float, forest: bool) -> Iterator[tuple[float, Tree]]:
    """(base value, tree) for all leaves of a tree, in parts that fit one broadcast."""
    by_id = {n.id: n for n in nodes.itertuples(index=False)}

    def cover(n) -> float:
        return float(sum(n.stats)) if forest else float(n.rawCount)

    def value(n) -> float:
        return weight * (n.stats[1] / sum(n.stats) if forest else n.prediction)

    part, places, path, leaves = [], [], [], 0
    stack = [(by_id[0], 0, (-1, -np.inf, np.inf, 1.0))]
    while stack:
        node, depth, reached = stack.pop()
        del path[depth:], places[depth:]
        if leaves and node.leftChild < 0 and NODE_BYTES * len(part) > BROADCAST_BYTES:
            yield _tree(part)
            # The next part begins with the nodes above this one.
            part, places, leaves = [], [], 0
        path.append((reached, value(node) if node.leftChild < 0 else 0.0))
        for at in range(len(places), len(path)):
            (feature, low, high, share), own = path[at]
            above = next((places[i] for i in range(at - 1, 0, -1) if path[i][0][0] == feature), -1)
            places.append(len(part))
            part.append((places[at - 1] if at else -1, above, feature, low, high, share, own, at))
        if node.leftChild < 0:
            leaves += 1
            continue
        feature = node.feature
        low, high, share = next((r[1:] for r, _ in reversed(path) if r[0] == feature), (-np.inf, np.inf, 1.0))
        left, right = by_id[node.leftChild], by_id[node.rightChild]
        total = cover(left) + cover(right)
        for child, bounds in ((right, (max(low, node.threshold), high)), (left, (low, min(high, node.threshold)))):
            passed = cover(child) / total if total else 0.5
            stack.append((child, depth + 1, (feature, *bounds, share * passed)))
    yield _tree(part)


def _tree(part: list[tuple]) -> tuple[float, Tree]:
    """Nodes as they were met, by level; base value: leaves by the share that reaches them."""
    parent, above, feature, low, high, share, value, level = (np.array(c) for c in zip(*part))
    order = np.argsort(level, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    moved = lambda links: np.where(links >= 0, place[links], -1)[order]
    parent, above = moved(parent), moved(above)
    levels = np.cumsum(np.bincount(level))
    feature, share, value = feature[order], np.maximum(share[order], TINY), value[order]
    reach, met = np.ones(len(order)), np.zeros(len(order), dtype=np.int64)
    for i in range(1, len(order)):
        again = above[i] >= 0
        reach[i] = reach[parent[i]] * share[i] / (share[above[i]] if again else 1.0)
        met[i] = met[parent[i]] + (not again)
    base = float((value * reach).sum())
    return base, Tree(parent, above, feature, low[order], high[order], share, value, levels, int(met.max()))


def explain_batch(x: np.ndarray, trees: list[Tree]) -> np.ndarray:
    """Attributions of a batch: array operations over the nodes of a level, the points and rows."""
    phi = np.zeros((x.shape[1], len(x)))
    for tree in trees:
        if not tree.depth:
            continue
        points, weights = np.polynomial.legendre.leggauss((tree.depth + 1) // 2)
        t, weights = (points + 1) / 2, weights / 2
        step = max(1, min(ROWS_AT_ONCE, CELLS_AT_ONCE // (len(tree.parent) * len(t))))
        for start in range(0, len(x), step):
            _add_tree(np.ascontiguousarray(x[start : start + step].T), tree, t, weights, phi[:, start : start + step])
    return phi.T


def _add_tree(rows: np.ndarray, tree: Tree, t: np.ndarray, weights: np.ndarray, phi: np.ndarray) -> None:
    admitted = (rows[tree.feature] > tree.low[:, None]) & (rows[tree.feature] <= tree.high[:, None])
    absent = tree.share[:, None] * (1 - t)
    present = absent + t

    def factor(some) -> np.ndarray:
        return np.where(admitted[some][:, None, :], present[some][:, :, None], absent[some][:, :, None])

    sums = np.empty((len(tree.parent), len(t), rows.shape[1]))
    sums[0] = 1.0
    spans = [slice(a, b) for a, b in zip(tree.levels, tree.levels[1:])]
    for span in spans:
        np.take(sums, tree.parent[span], axis=0, out=sums[span])
        sums[span] *= factor(span)
        again = np.flatnonzero(tree.before[span] >= 0)
        if len(again):
            sums[span.start + again] /= factor(tree.before[span][again])
    inner = np.zeros(len(tree.parent), dtype=bool)
    inner[tree.parent[1:]] = True
    for span in reversed(spans):
        ends = span.start + np.flatnonzero(~inner[span])
        sums[ends] *= tree.value[ends, None, None]
        parents = tree.parent[span]
        firsts = np.flatnonzero(np.append(True, np.diff(parents) != 0))
        sums[parents[firsts]] = np.add.reduceat(sums[span], firsts, axis=0)
    # What the feature of each node adds, and what the one it replaces no longer does.
    below = slice(1, len(tree.parent))
    again = np.flatnonzero(tree.before >= 0)
    for some, nodes, sign in ((below, np.arange(1, len(tree.parent)), 1.0), (again, tree.before[again], -1.0)):
        if not len(nodes):
            continue
        # Integrals without the factor of a node, once for each way that factor can be.
        with_it = np.matmul((weights / present[nodes])[:, None, :], sums[some])[:, 0]
        without = np.matmul((weights / absent[nodes])[:, None, :], sums[some])[:, 0]
        share = tree.share[nodes, None]
        gain = sign * np.where(admitted[nodes], (1 - share) * with_it, -share * without)
        features = tree.feature[nodes]
        order = np.argsort(features, kind="stable")
        firsts = np.flatnonzero(np.append(True, np.diff(features[order]) != 0))
        phi[features[order][firsts]] += np.add.reduceat(gain[order], firsts, axis=0)


def attribution_column(spark: SparkSession, values: Column, trees: list[Tree]) -> Column:
    # Arrays only: executors need no class of this package to read a broadcast.
    shipped = spark.sparkContext.broadcast([astuple(t) for t in trees])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def attributions(batch: pd.Series) -> pd.Series:
        if len(batch) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(explain_batch(np.stack(batch.to_numpy()), [Tree(*arrays) for arrays in shipped.value])))

    return attributions(values)


def model_trees(model: FailureModel) -> list[tuple[float, list[Tree]]]:
    """Trees of a fitted model, for callers that explain batch after batch."""
    if model.kind == "baseline":
        raise ValueError("attributions need a tree model")
    nodes, weights, forest = ensemble_nodes(model)
    return tree_groups(node_table(nodes), weights, forest)


def with_attributions(df: DataFrame, model: FailureModel, trees: list[tuple[float, list[Tree]]] | None = None) -> DataFrame:
    """Adds ``values``, ``attributions`` (both in model feature order) and ``base``.

    Attributions are in the space of the raw score: log-odds margin of boosted trees
    (half of it, as Spark's probability is sigmoid(2 margin)), class-1 share of a forest.
    """
    return with_tree_attributions(with_values(df, model.features), trees or model_trees(model))


def with_tree_attributions(df: DataFrame, groups: list[tuple[float, list[Tree]]]) -> DataFrame:
    """Adds ``attributions`` and ``base`` to rows with ``values``."""
    parts = []
    for i, (_, trees) in enumerate(groups):
        df = df.withColumn(f"_a{i}", attribution_column(df.sparkSession, F.col("values"), trees))
        parts.append(f"_a{i}")
    total = F.col(parts[0])
    for p in parts[1:]:
        total = F.zip_with(total, F.col(p), lambda a, b: a + b)
    return (
        df.withColumn("attributions", total)
        .withColumn("base", F.lit(sum(base for base, _ in groups)))
        .drop(*parts)
    )


def long_attributions(df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """One row per row and feature: feature, value, attribution."""
    triples = F.arrays_zip(
        F.array(*map(F.lit, features)).alias("feature"), F.col("values").alias("value"),
        F.col("attributions").alias("attribution"),
    )
    return df.select(*keys, F.inline(triples))


def attribution_importance(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute attribution per feature, largest first; one column per feature until the end."""
    means = df.agg(*[F.avg(F.abs(F.col("attributions")[i])).alias(f"m{i}") for i in range(len(features))])
    rows = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("importance")) for i, f in enumerate(features)]
    )
    return means.select(F.inline(rows)).orderBy(F.desc("importance"), "feature")


def background_sample(df: DataFrame, keys: list[str], n: int = 100, seed: int = SEED) -> DataFrame:
    """n rows by a seeded hash of their keys: the same rows under any partitioning."""
    digest = F.md5(F.concat_ws("|", *[named(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(digest, *map(named, keys)).limit(n)


def additivity(df: DataFrame, model: FailureModel) -> DataFrame:
    """Errors of base + sum(attributions) against the raw score and the probability.

    One row: the smaller error decides the space; below 0.1 the attributions are valid.
    """
    total = F.aggregate("attributions", F.col("base"), lambda acc, x: acc + x)
    if model.kind == "random_forest":
        raw, probability = F.col("probability"), total
    else:
        raw, probability = F.col("margin"), logistic(F.lit(2.0) * total)
    in_raw, in_probability = F.abs(total - raw), F.abs(probability - F.col("probability"))
    share = F.aggregate("attributions", F.lit(0.0), lambda acc, x: acc + F.abs(x))
    errors = df.agg(
        F.max(in_raw).alias("max_raw"), F.avg(in_raw).alias("mean_raw"),
        F.max(in_probability).alias("max_probability"), F.avg(in_probability).alias("mean_probability"),
        F.max("base").alias("expected_value"), F.max(share).alias("largest"),
    )
    better = F.col("max_raw") < F.col("max_probability")
    largest = F.when(better, F.col("max_raw")).otherwise(F.col("max_probability"))
    mean = F.when(better, F.col("mean_raw")).otherwise(F.col("mean_probability"))
    return errors.select(
        largest.alias("max_error"),
        mean.alias("mean_error"),
        "expected_value",
        F.when(better, "log-odds").otherwise("probability").alias("validation_space"),
        (largest < 0.1).alias("is_valid"),
        F.when(largest > 0.5, "high maximum error").when(mean > 0.1, "high mean error").alias("warning"),
        (F.col("largest") > 0).alias("some_importance"),
    )


def summary_points(df: DataFrame, features: list[str], keys: list[str], top: int = 20) -> DataFrame:
    """Attribution and value per row for the ``top`` most important features.

    ``df`` is read twice, to rank and to list, so it should be a written table.
    """
    ranked = attribution_importance(df, features).limit(top).collect()  # at most ``top`` rows
    points = F.array(
        *[
            F.struct(
                F.lit(r["feature"]).alias("feature"),
                F.col("values")[features.index(r["feature"])].alias("value"),
                F.col("attributions")[features.index(r["feature"])].alias("attribution"),
                F.lit(r["importance"]).alias("importance"),
            )
            for r in ranked
        ]
    )
    return df.select(*keys, F.inline(points))


def waterfall_points(df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Base, value and attribution per feature with the running score, for the rows given.

    Serves force and waterfall pictures; features go by size of their attribution.
    """
    items = F.transform(
        F.sequence(F.lit(0), F.lit(len(features) - 1)),
        lambda i: F.struct(
            F.abs(F.col("attributions")[i]).alias("size"), i.alias("index"),
            F.col("values")[i].alias("value"), F.col("attributions")[i].alias("attribution"),
        ),
    )
    names = F.array(*map(F.lit, features))
    ordered = df.select(*keys, "base", F.sort_array(items, asc=False).alias("all"))
    placed = ordered.select("*", F.posexplode("all").alias("position", "item"))
    running = F.aggregate(
        F.slice("all", F.lit(1), F.col("position") + 1), F.col("base"), lambda acc, x: acc + x["attribution"]
    )
    return placed.select(
        *keys, "position", F.get(names, F.col("item.index")).alias("feature"), F.col("item.value").alias("value"),
        F.col("item.attribution").alias("attribution"), "base", running.alias("score_after"),
    )


def dependence_points(df: DataFrame, features: list[str], feature: str, keys: list[str]) -> DataFrame:
    """Value against attribution of one feature."""
    i = features.index(feature)
    return df.select(
        *map(named, keys), F.lit(feature).alias("feature"), F.col("values")[i].alias("value"),
        F.col("attributions")[i].alias("attribution"),
    )
