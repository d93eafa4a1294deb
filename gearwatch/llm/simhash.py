"""Near duplicates by SimHash: fingerprints within a few bits, found with vantage-point trees.

Hamming distance over a part of the bits is a metric too, and fingerprints that differ in at most
``distance`` bits differ in at most ``distance // parts`` bits of one of ``parts`` equal parts.
For each part, a routing tree of vantage points cuts the fingerprints into shards: inside a node
are those within its radius. A fingerprint lives in one shard and visits those whose boundary it
may overlap by the triangle inequality, so each close pair meets in the shard of one of the two.
Shards go on with trees of their own and compare whole fingerprints, so pairs are exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.llm.common import LOWER_AZ, as_bytes, stored
from gearwatch.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DISTANCE, PARTS, SHINGLE = 3, 2, 3
#: Fingerprints a shard holds on average, most shards of a part, sampled fingerprints per shard.
SHARD_SIZE, MOST_SHARDS, SAMPLE = 1024, 16384, 32
#: Below this many, fingerprints are compared one by one.
LEAF = 96
FULL = np.uint64(2**64 - 1)


# --- fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every shingle; a shorter text is one shingle, no words are none."""
    found = text.translate(LOWER_AZ).split()
    if len(found) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(found), 42)] if found else []
    runs = zip(*(found[i:] for i in range(size)))
    return [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]


def _majorities(hashes: list[int], counts: list[int]) -> np.ndarray:
    """Fingerprint of each text from the hashes of all, text after text; every count is above 0."""
    bits = np.unpackbits(np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > np.array(counts)[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def simhashes(texts, size: int = SHINGLE, block: int = 20_000) -> np.ndarray:
    """Fingerprints of texts given as bytes. Long texts are summed up block by block."""
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes, counts, rows = [], [], []

    def flush() -> None:
        if rows:
            out[rows] = _majorities(hashes, counts)
            hashes.clear(), counts.clear(), rows.clear()

    for row, text in enumerate(texts):
        own = shingle_hashes(text, size)
        if len(own) > block:
            ones = sum(
                np.unpackbits(np.array(own[i : i + block], dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
                .sum(axis=0, dtype=np.int64)
                for i in range(0, len(own), block)
            )
            out[row] = np.packbits(2 * ones > len(own)).view(">u8")[0]
        elif own:
            hashes += own
            counts.append(len(own))
            rows.append(row)
            if len(hashes) > block:
                flush()
    flush()
    return out


def fingerprint(text: Column | str, size: int = SHINGLE) -> Column:
    """SimHash of a text as a long (the same 64 bits, signed); 0 for null and blank texts."""

    @F.pandas_udf(T.LongType())
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(simhashes(texts.tolist(), size).view(np.int64))

    return column(as_bytes(text))


# --- trees --------------------------------------------------------------------------------


def apart(a: np.ndarray, b, mask=FULL) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask)


def choose_split(points: np.ndarray, mask: np.uint64, tries: int = 6) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve the points; the widest spread of distances wins.

    None if no tried point tells the others apart.
    """
    best, width = None, -1.0
    for v in points[np.linspace(0, len(points) - 1, tries).astype(int)]:
        d = apart(points, v, mask)
        if d.min() == d.max():
            continue
        radius = int(np.median(d))
        if radius >= d.max():
            radius = int(d[d < d.max()].max())
        if d.std() > width:
            best, width = (v, radius), float(d.std())
    return best


def routing_tree(points: np.ndarray, mask: np.uint64, leaves: int) -> list[tuple]:
    """Nodes (vantage point, radius, inside, outside), or (None, leaf number, 0, 0)."""
    nodes: list[tuple] = []
    open_ones = [(len(points), 0, points)]
    nodes.append(None)
    while open_ones and len(open_ones) < leaves:
        # The fullest node is split next.
        at = max(range(len(open_ones)), key=lambda i: open_ones[i][0])
        n, place, own = open_ones[at]
        split = choose_split(own, mask) if n > 4 else None
        if split is None:
            if n <= 4:
                break
            open_ones[at] = (0, place, own)  # cannot be split: no longer the fullest
            if not any(o[0] for o in open_ones):
                break
            continue
        inside = apart(own, split[0], mask) <= split[1]
        nodes[place] = (split[0], split[1], len(nodes), len(nodes) + 1)
        open_ones[at] = (int(inside.sum()), len(nodes), own[inside])
        open_ones.append((int((~inside).sum()), len(nodes) + 1, own[~inside]))
        nodes += [None, None]
    for number, (_, place, _) in enumerate(open_ones):
        nodes[place] = (None, number, 0, 0)
    return nodes


def children(d: np.ndarray, home: np.ndarray, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Who goes inside, who goes outside, and who of those outside lives there.

    A pair that a node separates lives inside and outside, so only those inside visit.
    """
    within = d <= radius
    overlap = d + reach > radius
    inside = np.where(home, within, d <= radius + reach)
    outside = np.where(home, ~within | overlap, overlap)
    return inside, outside, home & ~within


def route(prints: np.ndarray, tree: list[tuple], mask: np.uint64, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, rows, whether they live there) for every leaf that rows live in or visit."""
    stack = [(0, np.arange(len(prints)), np.ones(len(prints), dtype=bool))]
    while stack:
        place, rows, home = stack.pop()
        if not len(rows):
            continue
        vantage, radius, inner, outer = tree[place]
        if vantage is None:
            yield radius, rows, home
            continue
        inside, outside, outer_home = children(apart(prints[rows], vantage, mask).astype(np.int64), home, radius, reach)
        stack.append((inner, rows[inside], home[inside]))
        stack.append((outer, rows[outside], outer_home[outside]))


def _leaf_links(prints: np.ndarray, nodes: np.ndarray, own: np.ndarray, guests: np.ndarray, distance: int, out: list) -> None:
    """A spanning forest of the close pairs: per group of close own rows a star, per guest one link to each group."""
    group = np.full(len(own), -1)
    left = np.arange(len(own))
    while len(left):
        frontier, members = [left[0]], [left[0]]
        left = left[1:]
        while frontier and len(left):
            near = apart(prints[own[left]], prints[own[frontier.pop()]]) <= distance
            if near.any():
                frontier += left[near].tolist()
                members += left[near].tolist()
                left = left[~near]
        ids = nodes[own[members]]
        low = ids.min()
        group[members] = low
        out += [(i, low) for i in ids.tolist() if i != low]
    step = max(1, 1_000_000 // max(1, len(own)))
    for i in range(0, len(guests), step):
        some = guests[i : i + step]
        who, whom = np.nonzero(apart(prints[some][:, None], prints[own][None, :]) <= distance)
        if len(who):
            out += list(set(zip(nodes[some[who]].tolist(), group[whom].tolist())))


def shard_links(prints: np.ndarray, nodes: np.ndarray, home: np.ndarray, mask: np.uint64, reach: int, distance: int) -> list[tuple[int, int]]:
    """Links that connect all rows of a shard that are within ``distance`` of a row that lives there."""
    out: list[tuple[int, int]] = []
    stack = [(np.arange(len(prints)), home, mask, reach)]
    while stack:
        rows, live, by, slack = stack.pop()
        homes = rows[live]
        if not len(homes):
            continue
        split = choose_split(prints[homes], by) if len(homes) > LEAF else None
        if split is None:
            if len(homes) > LEAF and by != FULL:
                stack.append((rows, live, FULL, distance))  # alike in this part: go on by all bits
            else:
                _leaf_links(prints, nodes, homes, rows[~live], distance, out)
            continue
        inside, outside, outer_home = children(apart(prints[rows], split[0], by).astype(np.int64), live, split[1], slack)
        if max(inside.sum(), outside.sum()) > 0.95 * len(rows) and min(inside.sum(), outside.sum()) > 0.5 * len(rows):
            # Nearly all overlap the boundary: trees no longer prune.
            if by != FULL:
                stack.append((rows, live, FULL, distance))
            else:
                _leaf_links(prints, nodes, homes, rows[~live], distance, out)
            continue
        stack.append((rows[inside], live[inside], by, slack))
        stack.append((rows[outside], outer_home[outside], by, slack))
    return out


# --- the operator ---------------------------------------------------------------------------


def close_links(prints: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """(a, b): links that connect fingerprints within ``distance`` bits.

    ``prints`` has one row (fingerprint, node) per distinct fingerprint, ``node`` a number of its
    own. Links form the same components as all close pairs, but a dense group of K fingerprints
    gives about K links, not K * K. Vantage points come from a sample of at most about
    ``MOST_SHARDS * SAMPLE`` fingerprints (4 MB); it decides only where shards are cut.
    """
    spark = prints.sparkSession
    total = prints.count()
    shards = int(min(MOST_SHARDS, max(1, total // SHARD_SIZE)))
    share = min(1.0, shards * SAMPLE / max(1, total))
    sample = prints.where(F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < int(share * (1 << 30)))
    points = np.sort(np.array([r[0] for r in sample.select("fingerprint").collect()], dtype=np.int64).view(np.uint64))
    points = points[np.random.default_rng(7).permutation(len(points))]
    width, reach = 64 // parts, distance // parts
    masks = [np.uint64(((1 << width) - 1) << (width * i)) if parts > 1 else FULL for i in range(parts)]
    trees = spark.sparkContext.broadcast([routing_tree(points, m, shards) for m in masks] if len(points) else [])

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fingerprint"].to_numpy().view(np.uint64)
            for part, (mask, tree) in enumerate(zip(masks, trees.value)):
                for leaf, rows, home in route(own, tree, mask, reach):
                    yield pd.DataFrame({
                        "part": np.int32(part), "shard": np.int32(leaf), "home": home,
                        "fingerprint": batch["fingerprint"].to_numpy()[rows], "node": batch["node"].to_numpy()[rows],
                    })

    def linked(key, shard: pd.DataFrame) -> pd.DataFrame:
        found = shard_links(
            shard["fingerprint"].to_numpy().view(np.uint64), shard["node"].to_numpy(), shard["home"].to_numpy(),
            masks[key[0]], reach, distance,
        )
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    placed = prints.mapInPandas(routed, "part int, shard int, home boolean, fingerprint long, node long")
    return placed.groupBy("part", "shard").applyInPandas(linked, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fingerprint, component_id, *keep) per row of ``docs``.

    component_id is the smallest id that can be reached over links of at most three differing
    bits. Null and blank texts have fingerprint 0 and link like any other. Repeated rows each get
    a row. Rows without an id get the component of their fingerprint, null if no row of it has an
    id, and make no links. Very long texts are read whole. Equal fingerprints collapse to one
    node before anything is compared. Only ``id_col``, ``text_col`` and ``keep`` are read.
    """
    named = docs.select(F.col(id_col).cast("long").alias(id_col), fingerprint(F.col(text_col)).alias("fingerprint"), *keep)
    prints, _ = stored(named, "prints")
    nodes, _ = stored(prints.groupBy("fingerprint").agg(F.min(id_col).alias("node")), "nodes")
    roots = connected_components(close_links(nodes.where(F.col("node").isNotNull())), "a", "b")
    found = nodes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    return prints.join(found, "fingerprint").select(id_col, "fingerprint", "component_id", *keep)
