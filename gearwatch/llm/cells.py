"""Centroid clustering over a vector approximation file.

Each component of a vector becomes one of ``2 ** bits`` cells, cut at quantiles of the component
over all rows. The file holds the cells of a vector beside the whole vector. For every centroid a
lookup table gives what the least and the greatest value in a cell add to the distance, so sums
over cells are an interval that holds the distance; what a vector adds to all distances alike, its
own square, is left out of both ends, which makes intervals narrower. Where one centroid's interval
lies below all others, it is the nearest; only where intervals overlap is the whole vector fetched
and compared, and only with the centroids that overlap.

Sums of clusters are carried from round to round: a vector is fetched for them only when it moves.
A round is one scan without a shuffle of vectors; each task hands on one line of sums per cluster.
Rounds keep no state but the centroids, so a lost task is simply run again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import stored
from gearwatch.llm.vectors import matrix, products, whole_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 6


def cell_edges(vectors: DataFrame, dims: int, bits: int) -> np.ndarray | None:
    """Quantiles (dims, 2 ** bits + 1) of every component of ``v`` over all rows, ends included."""
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    picked = [F.col("v")[d] for d in range(dims)]
    inner = [F.percentile_approx(c, shares, 1000).alias(f"q{d}") for d, c in enumerate(picked)]
    ends = [F.array(F.min(c), F.max(c)).alias(f"e{d}") for d, c in enumerate(picked)]
    row = vectors.agg(*inner, *ends).first()
    if row["q0"] is None:
        return None
    return np.array([[row[f"e{d}"][0], *row[f"q{d}"], row[f"e{d}"][1]] for d in range(dims)], dtype=np.int64)


def cells_of(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cell (n, dims) of every component; cell c reaches from edge c to edge c + 1, ends included."""
    return np.stack([np.searchsorted(e[1:-1], v[:, d]) for d, e in enumerate(edges)], axis=1).astype(np.uint8)


def lookup(edges: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(dims, cells, 2 * k): least and greatest addition of a cell to each centroid's distance."""
    c = centroids.T[:, None, :]
    low, high = -2 * c * edges[:, :-1, None], -2 * c * edges[:, 1:, None]
    return np.concatenate([c * c + np.minimum(low, high), c * c + np.maximum(low, high)], axis=2)


def nearest(cells: np.ndarray, v: np.ndarray, table: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of each row's nearest centroid, ties to the smaller, and how many rows were fetched."""
    k = len(centroids)
    ends = np.zeros((len(cells), 2 * k), dtype=np.int64)
    for d in range(cells.shape[1]):
        ends += table[d][cells[:, d]]
    near = ends[:, :k] <= ends[:, k:].min(axis=1)[:, None]
    out = near.argmax(axis=1)
    fetched = np.flatnonzero(near.sum(axis=1) > 1)
    exact = (centroids * centroids).sum(axis=1) - 2 * products(v[fetched], centroids)
    out[fetched] = np.where(near[fetched], exact, np.iinfo(np.int64).max).argmin(axis=1)
    return out, len(fetched)


def _moves(file: DataFrame, edges: np.ndarray, before: np.ndarray | None, now: np.ndarray) -> list:
    """What clusters gain from one set of centroids to the next: (cluster, dim, sum, n), dim -1 for counts."""
    k, dims = now.shape
    tables = [None if c is None else lookup(edges, c) for c in (before, now)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = np.zeros((k, dims + 1), dtype=np.int64)  # the last column counts
        for batch in batches:
            cells = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, dims)
            v = matrix(batch.column(0), dims)
            to, _ = nearest(cells, v, tables[1], now)
            moved = np.arange(len(v))
            if before is not None:
                was, _ = nearest(cells, v, tables[0], before)
                moved = np.flatnonzero(was != to)
                _add(gained, was[moved], v[moved], -1)
            _add(gained, to[moved], v[moved], 1)
        at = np.argwhere(gained)
        values = [at[:, 0].astype(np.int32), at[:, 1].astype(np.int32), gained[tuple(at.T)]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], names=["cluster", "dim", "gain"])

    gains = file.select("v", "cells").mapInArrow(run, "cluster int, dim int, gain long")
    return gains.groupBy("cluster", "dim").agg(F.sum("gain").alias("gain")).collect()  # at most k * (dims + 1) rows


def _add(gained: np.ndarray, clusters: np.ndarray, v: np.ndarray, sign: int) -> None:
    for c in np.unique(clusters):
        own = v[clusters == c]
        gained[c, :-1] += sign * own.sum(axis=0)
        gained[c, -1] += sign * len(own)


def clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    dims: int = 64,
    seed: int = 3,
    bits: int = BITS,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) per vector that takes part.

    Vectors of another length than ``dims``, null ones and ones with a null or non-finite component
    take no part. Components are ``floor(scale * x)``, at most 2 ** 27 away from zero. The first
    centroids are the ``k`` vectors with the smallest sha256 of ``seed:id``, rows without an id last,
    ties by the vector; fewer vectors give fewer centroids. Repeated rows count as often as they
    occur. ``rounds`` end early only when centroids stay as they are, which no later round changes.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    own_id = F.col(f"`{id_col}`")
    picked = whole_vectors(vectors.select(own_id.alias("id"), F.col(f"`{vector_col}`").alias("given")), "given", scale, "v", dims)
    kind = picked.schema["id"].dataType.simpleString()
    edges = cell_edges(picked, dims, bits)
    if edges is None:
        nothing = "cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>"
        return spark.createDataFrame([], f"id {kind}, {nothing}").withColumnRenamed("id", id_col)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cells_of(matrix(batch.column(1), dims), edges)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in cells], pa.binary())], names=["id", "v", "cells"])

    file, _ = stored(picked.mapInArrow(approximate, f"id {kind}, v array<int>, cells binary"), "cells")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = file.select(mark.alias("mark"), "v").orderBy(F.col("mark").asc_nulls_last(), "v").limit(k).collect()
    now = np.array([r["v"] for r in first], dtype=np.int64)
    held = np.zeros((len(now), dims + 1), dtype=np.int64)
    before = None
    for _ in range(rounds):
        for r in _moves(file, edges, before, now):
            held[r["cluster"], r["dim"]] += r["gain"]
        n = held[:, -1:]
        new = np.where(n > 0, held[:, :-1] // np.maximum(n, 1), now)
        if (new == now).all():
            break
        before, now = now, new
    table = lookup(edges, now)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, dims)
            v = matrix(batch.column(1), dims)
            to, _ = nearest(cells, v, table, now)
            away = ((v - now[to]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to.astype(np.int32)), pa.array(away)], names=["id", "cluster", "distance"])

    found, _ = stored(file.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # k rows
    total = sum(int(r["own"]) for r in sums)
    lines = [(r["cluster"], int(r["own"]), total, now[r["cluster"]].tolist()) for r in sums]
    small = spark.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    out = found.join(F.broadcast(small), "cluster")  # k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _sql(k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3) -> str:
    """The same in DuckDB: every distance in every round."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS INTEGER) AS cluster, x AS c
  FROM v QUALIFY cluster < {k})""",
    ]
    distance = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, row, any_value(x) AS x, min(struct_pack(d := d, cluster := cluster)) AS best
  FROM (SELECT vec_id, row, x, cluster, CAST({distance} AS BIGINT) AS d FROM v, c{r}) GROUP BY vec_id, row)"""
        )
        if r < rounds:
            means = f"list_transform(range(1, {dims + 1}), lambda i: CAST(list_sum(list_transform(xs, lambda y: y[i])) AS BIGINT))"
            floor = "list_transform(s, lambda t: (t - ((t % n) + n) % n) // n)"
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, {floor} AS m FROM (
      SELECT cluster, len(xs) AS n, {means} AS s
      FROM (SELECT best.cluster AS cluster, list(x) AS xs FROM a{r} GROUP BY ALL))) USING (cluster))"""
            )
    last = f"a{rounds}"
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.cluster AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} ON c{rounds}.cluster = best.cluster"""


SQL = _sql()
