import hashlib
import math

import numpy as np
import pytest

from gearwatch.llm import cells

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cells string, cluster string"


def plain(rows, k=8, rounds=10, scale=1024, dims=64, seed=3):
    """(id, cluster, distance, cluster inertia, inertia, centroid), every distance in every round."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~"
    c = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    away = lambda v, w: sum((x - y) ** 2 for x, y in zip(v, w))
    place = lambda: [min(range(len(c)), key=lambda j: (away(v, c[j]), j)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        for j in range(len(c)):
            own = [v for (_, v), a in zip(kept, at) if a == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    d = [away(v, c[a]) for (_, v), a in zip(kept, at)]
    return [(i, a, x, sum(y for y, b in zip(d, at) if b == a), sum(d), c[a]) for (i, _), a, x in zip(kept, at, d)]


def found(spark, rows, schema=SCHEMA, **settings):
    full = [(i, v, 0, "x", "x", "x") for i, v in rows]
    out = cells.clusters(spark.createDataFrame(full, schema).repartition(4), **settings)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 4, 6])
def test_as_by_the_book(spark, bits):
    rng = np.random.default_rng(bits)
    rows = [(i, [float(x) for x in rng.normal(size=6) + 3 * (i % 5)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(200)]  # a third are one vector
    assert found(spark, rows, dims=6, bits=bits) == sorted(plain(rows, dims=6), key=str)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [0.5]), (7, [1.0, 2.0, 3.0]),
            (8, [0.5, -0.5]), (8, [0.5, -0.5]), (8, [0.25, 0.0]), (None, [0.0, 0.0]), (9, [-0.0001, 0.0001]), (10, [1.0, 1.0])]
    got = found(spark, rows, dims=2, k=3)
    assert got == sorted(plain(rows, dims=2, k=3), key=str) and len(got) == 6
    assert found(spark, rows, dims=2, k=50) == sorted(plain(rows, dims=2, k=50), key=str)
    assert found(spark, rows[:7], dims=2) == []
    assert found(spark, [], dims=2) == []


def test_far_components_count_as_the_bound(spark):
    got = found(spark, [(1, [3e38]), (2, [-3e38]), (3, [0.0])], dims=1, k=2)
    assert len(got) == 3 and all(r[2] >= 0 for r in got)


def test_only_overlapping_intervals_are_fetched():
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.integers(-100, 100, (500, 4)) + 5000, rng.integers(-100, 100, (500, 4)) - 5000])
    edges = np.stack([np.quantile(v[:, d], np.linspace(0, 1, 17)).astype(np.int64) for d in range(4)])
    edges[:, 0], edges[:, -1] = v.min(axis=0), v.max(axis=0)
    c = np.array([[5000] * 4, [-5000] * 4])
    at, fetched = cells.nearest(cells.cells_of(v, edges), v, cells.lookup(edges, c), c)
    assert at.tolist() == [0] * 500 + [1] * 500 and fetched < 10  # one cell spans the gap
    # Equal centroids always overlap, and the smaller number wins.
    at, fetched = cells.nearest(cells.cells_of(v, edges), v, cells.lookup(edges, c[[0, 0]]), c[[0, 0]])
    assert not at.any() and fetched == 1000
