import math

import numpy as np
import pytest

from gearwatch.llm import retrieval
from gearwatch.llm.vectors import products

SCHEMA = "vec_id long, embedding array<float>, row string, score string, query string"


def plain(rows, k=5, every=50, scale=256):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for m, (j, v) in enumerate(kept) if m != n]
        out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], SCHEMA).repartition(3)
    out = retrieval.top_products(df, **settings)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_as_by_the_book(spark, spread, monkeypatch):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(9, 8))
    v = centre[rng.integers(0, 9, 1200)] + rng.normal(size=(1200, 8)) * 0.2
    v *= np.exp(rng.normal(size=(1200, 1)) * spread)
    rows = [(i, [float(x) for x in w]) for i, w in enumerate(v)]
    rows += [(1200 + i, rows[50][1]) for i in range(600)]  # a third are copies of a query
    monkeypatch.setattr(retrieval, "BUCKET", 128)
    monkeypatch.setattr(retrieval, "BLOCK", 64)  # eight queries at a time
    assert found(spark, rows) == plain(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [-1.0, -1.0]), (100, []), (150, None), (200, [float("nan"), 1.0]),
            (250, [1.0, None]), (None, [1.0, 1.0]), (-50, [0.0, 0.0]), (3, [0.5]), (4, [1.0, 2.0, 9.0]), (5, [1e20, 1.0])]
    got = found(spark, rows[:-1])
    assert got == plain(rows[:-1]) and len(got) == 5 * 5
    assert len(found(spark, rows)) == 5 * 5
    assert found(spark, rows, k=100)[:1] and len(found(spark, rows[:-1], k=100)) == 5 * 7
    assert found(spark, rows[:1]) == [] and found(spark, rows[-1:]) == [] and found(spark, []) == []


def test_coordinates_pass_over_no_vector_within_the_angle():
    rng = np.random.default_rng(8)
    v = rng.integers(-200, 200, (3000, 6))
    bucket = retrieval.Bucket(v, np.arange(3000), np.ones(3000, bool), np.arange(3000))
    fewer = 0
    for q in rng.integers(-200, 200, (40, 6)):
        for floor in (0.6, 0.9, 0.99):
            unit = q / np.linalg.norm(q)
            left = set(bucket.by_coordinates(unit, floor).tolist())
            reach = np.flatnonzero(bucket.v @ unit / bucket.size >= floor)
            assert set(reach.tolist()) <= left
            fewer += len(left) < 1500
    assert fewer > 40


def test_products_are_exact():
    a = np.array([[2**27, 3], [-(2**27), 1]], dtype=np.int64)
    assert products(a, a).tolist() == [[2**54 + 9, -(2**54) + 3], [-(2**54) + 3, 2**54 + 1]]
