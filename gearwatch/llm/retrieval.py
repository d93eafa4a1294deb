"""Exact top-k inner products by buckets of length.

Vectors are dealt out by length, the longest first, so the rows of a file have nearly one length
and each run of ``BUCKET`` rows is a bucket. Queries travel in blocks of ``BLOCK``, the candidates
stay where they are: a block is one scan without a shuffle of vectors. The k-th best score found so
far, divided by the length of the query and the greatest length in a bucket, is the cosine a vector
of this bucket must reach:

* above 1 the bucket is passed over, as for all buckets of shorter vectors after it;
* a high threshold is met by coordinates: a vector within an angle of the query has each coordinate
  within that angle of the query's own, so the vectors outside the range of the query's strongest
  coordinates are passed over, found by binary search in the bucket's sorted coordinate;
* a low one by length: vectors too short for the score are at the end of the bucket.

What is left is verified by whole-number products. Bounds are widened by ``SLACK``, so rounding
never passes a vector over. The first bucket is searched before the others, and the thresholds it
gives go out with the block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import stored
from gearwatch.llm.vectors import products, ragged_matrix, whole_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a bucket.
BUCKET = 2048
#: Numbers in a block of queries, so that what is sent to executors is at most 8 MB.
BLOCK = 1 << 20
#: Cosine from which coordinates are used, and how many of them.
STEEP, COORDINATES = 0.6, 4
SLACK = 1e-9
NONE = np.iinfo(np.int64).min + 1  # its negative fits


class Best:
    """The k best (score, id, row) found for each query, best first; ties to the smaller id, none last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.known = np.zeros((n, k), dtype=bool)
        self.row = np.full((n, k), -1)

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray) -> None:
        """Entries of several queries, in any order."""
        touched, at = np.unique(query, return_inverse=True)
        if not len(touched):
            return
        old = np.repeat(np.arange(len(touched)), self.k)
        line = np.concatenate([old, at])
        both = [np.concatenate([own[touched].ravel(), new]) for own, new in ((self.score, score), (self.id, ids), (self.known, known), (self.row, rows))]
        order = np.lexsort((both[3], both[1], ~both[2], -both[0], line))
        line = line[order]
        place = np.arange(len(line)) - np.searchsorted(line, line)
        best = order[place < self.k]
        for own, new in zip((self.score, self.id, self.known, self.row), both):
            own[touched] = new[best].reshape(len(touched), self.k)


def within_angle(q: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of a unit vector's coordinate whose cosine with a query with coordinate ``q`` is at least ``floor``."""
    own, apart = np.arccos(np.clip(q, -1, 1)), np.arccos(np.clip(floor, -1, 1))
    low = np.where(own + apart >= np.pi, -1.0, np.cos(np.minimum(own + apart, np.pi)))
    return low - SLACK, np.cos(np.maximum(own - apart, 0.0)) + SLACK


class Bucket:
    """Vectors of nearly one length, longest first."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray):
        size = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-size, kind="stable")
        self.v, self.ids, self.known, self.rows, self.size = v[order], ids[order], known[order], rows[order], size[order]
        self.longest = float(self.size[0]) if len(size) else 0.0
        self._sorted: dict = {}

    def coordinate(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinate d of the unit vectors, its order and its sorted values."""
        if d not in self._sorted:
            own = self.v[:, d] / np.maximum(self.size, 1e-300)
            order = np.argsort(own, kind="stable")
            self._sorted[d] = own, order, own[order]
        return self._sorted[d]

    def by_coordinates(self, unit: np.ndarray, floor: float) -> np.ndarray:
        """Places of the vectors whose strongest coordinates are within the angle of ``floor``."""
        strong = np.argsort(-np.abs(unit), kind="stable")[:COORDINATES]
        low, high = within_angle(unit[strong], np.full(len(strong), floor))
        spans = []
        for d, a, b in zip(strong, low, high):
            _, order, values = self.coordinate(int(d))
            spans.append(order[np.searchsorted(values, a, "left") : np.searchsorted(values, b, "right")])
        first = int(np.argmin([len(s) for s in spans]))
        left = spans[first]
        for i, d in enumerate(strong):
            if i != first and len(left):
                own = self.coordinate(int(d))[0][left]
                left = left[(own >= low[i]) & (own <= high[i])]
        return left

    def search(self, queries: np.ndarray, lengths: np.ndarray, own_rows: np.ndarray, least: np.ndarray, best: Best) -> None:
        """Offer every vector whose score with a query may reach what ``best`` and ``least`` ask for."""
        asked = np.maximum(least, best.score[:, -1])
        bound = asked > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            floor = np.where(bound, asked / (lengths * self.longest), -1.0)
        floor = np.where(np.isnan(floor), -1.0, floor)
        open_ones = floor <= 1 + SLACK
        steep = open_ones & (floor >= STEEP)
        for i in np.flatnonzero(steep):
            left = self.by_coordinates(queries[i] / lengths[i], min(1.0, floor[i] - SLACK))
            if len(left):
                score = products(self.v[left], queries[i : i + 1])[:, 0]
                self._offer(np.full(len(left), i), left, score, own_rows, asked, best)
        flat = np.flatnonzero(open_ones & ~steep)
        if len(flat):
            # Rows are sorted by length: those long enough for some query come first.
            reach = np.where(bound[flat], asked[flat], 0) / np.maximum(lengths[flat], 1e-300) * (1 - SLACK)
            end = int(np.searchsorted(-self.size, -reach.min(), "right"))
            for i in range(0, len(flat), 512):
                some = flat[i : i + 512]
                score = products(queries[some], self.v[:end])
                score[own_rows[some][:, None] == self.rows[:end]] = NONE
                need = asked[some]
                if end > best.k:
                    need = np.maximum(need, np.partition(score, end - best.k, axis=1)[:, end - best.k])
                q, c = np.nonzero((score >= need[:, None]) & (score > NONE))
                self._offer(some[q], c, score[q, c], own_rows, asked, best)

    def _offer(self, query, place, score, own_rows, asked, best: Best) -> None:
        right = (score >= asked[query]) & (self.rows[place] != own_rows[query])
        place = place[right]
        best.offer(query[right], score[right], self.ids[place], self.known[place], self.rows[place])


def _buckets(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Bucket]:
    for batch in batches:
        for i in range(0, batch.num_rows, BUCKET):
            part = batch.slice(i, BUCKET)
            ids = part.column(1)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            yield Bucket(ragged_matrix(part.column(2), dims), ids.fill_null(0).to_numpy(), known, part.column(0).to_numpy())


def top_products(
    vectors: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    scale: int = 256,
) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of every row whose id is divisible by ``every``.

    Components are ``floor(scale * x)``, at most 2 ** 27 away from zero; vectors that are null or
    hold a null or non-finite component take no part. Of vectors of several lengths the shorter
    counts as filled up with zeros; an empty one scores 0. Ties go to the smaller id, rows without an
    id last. Rows that share an id are rows of their own, as queries (each with its own lines) and
    as candidates. A table of one row, or an empty one, gives no lines; other columns are ignored.
    """
    spark = vectors.sparkSession
    picked = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("given"))
    whole = whole_vectors(picked, "given", scale, "v").withColumn("row", F.monotonically_increasing_id())
    # Longest first; equal lengths are spread by number, however many there are.
    squared = F.aggregate("v", F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x)
    numbered, _ = stored(whole.select("row", "id", "v", squared.alias("squared")), "vectors")
    laid = numbered.repartitionByRange(F.col("squared").desc(), "row").sortWithinPartitions(F.col("squared").desc(), "row")
    laid, _ = stored(laid, "lengths")
    asked = laid.where(F.pmod("id", F.lit(every)) == 0)
    shape = laid.agg(F.max(F.size("v")).alias("dims")).first()["dims"]
    parts = "query_id long, query long, id long, score long, candidate long"
    if shape is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    dims = max(1, shape)
    ahead = laid.orderBy(F.col("squared").desc(), "row").limit(BUCKET).select("row", "id", "v").toArrow()  # one bucket
    front = list(_buckets(ahead.combine_chunks().to_batches(), dims))

    def block_of(rows: list) -> DataFrame:
        """The best of all rows for at most ``BLOCK / dims`` queries, some per task."""
        own_rows = np.array([r["row"] for r in rows], dtype=np.int64)
        own_ids = np.array([r["id"] for r in rows], dtype=np.int64)
        queries = np.zeros((len(rows), dims), dtype=np.int64)
        for i, r in enumerate(rows):
            queries[i, : len(r["v"])] = r["v"]
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        begun = Best(len(rows), k)
        for bucket in front:
            bucket.search(queries, lengths, own_rows, np.full(len(rows), NONE), begun)
        sent = spark.sparkContext.broadcast((own_ids, own_rows, queries, lengths, begun.score[:, -1]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own_ids, own_rows, queries, lengths, least = sent.value
            best = Best(len(own_rows), k)
            for bucket in _buckets(batches, dims):
                bucket.search(queries, lengths, own_rows, least, best)
            q, place = np.nonzero(best.row >= 0)
            ids = pa.array(best.id[q, place], mask=~best.known[q, place])
            columns = [pa.array(own_ids[q]), pa.array(own_rows[q]), ids, pa.array(best.score[q, place]), pa.array(best.row[q, place])]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query", "id", "score", "candidate"])

        found, _ = stored(laid.select("row", "id", "v").mapInArrow(run, parts), "block")
        sent.destroy()
        return found

    found, waiting = [], []
    for r in asked.select("row", "id", "v").toLocalIterator():  # no more than one block is held
        waiting.append(r)
        if len(waiting) * dims >= BLOCK:
            found.append(block_of(waiting))
            waiting = []
    if waiting:
        found.append(block_of(waiting))
    if not found:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "candidate")
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


#: The same in DuckDB: every product, ranked.
SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, q.row AS query, c.vec_id AS vec_id, c.row AS row,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(q.x), len(c.x)) + 1), lambda i: q.x[i] * c.x[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST, row) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
