"""Shards by a permutation-filled lookup table.

Every shard has a preference order of the slots of a prime-sized table: an offset and a step, from
hashes of its name. Shards take turns, each claiming the next free slot it prefers. A key belongs
to the shard of the slot its hash falls in; when shards come or go, few keys move.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS = 256, 65_537
#: Largest table that is broadcast (8 MB).
MOST_SLOTS = 1_000_003


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(names: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> np.ndarray:
    """Number of the shard that owns each slot. A shard of weight w claims w slots a turn."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need distinct names, and there must be one")
    if not _is_prime(slots) or not len(names) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    weights = weights or [1] * len(names)
    if len(weights) != len(names) or min(weights) < 1:
        raise ValueError("every shard needs a weight of 1 or more")
    hashes = [hashlib.sha256(n.encode()).digest() for n in names]
    at = [int.from_bytes(h[:8], "big") % slots for h in hashes]
    step = [int.from_bytes(h[8:16], "big") % (slots - 1) + 1 for h in hashes]
    owner, free = [-1] * slots, slots
    while free:
        for shard, weight in enumerate(weights):
            for _ in range(min(weight, free)):
                while owner[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % slots
                owner[at[shard]] = shard
                free -= 1
            if not free:
                break
    return np.array(owner, dtype=np.int32)


def table_frame(spark: SparkSession, names: list[str], owner: np.ndarray) -> DataFrame:
    slots = pd.DataFrame({"slot": np.arange(len(owner), dtype="int32"), "shard": [names[i] for i in owner]})
    return spark.createDataFrame(slots, "slot int, shard string")


def place(docs: DataFrame, key_cols: tuple[str, ...] = ("doc_id",), names: list[str] | None = None, slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``.

    One broadcast of at most ``MOST_SLOTS`` rows, no shuffle. Equal keys, so repeated rows, share
    a shard; a null key has a slot like any other. Columns named slot or shard are replaced.
    An empty table stays empty.
    """
    names = names or shard_names(SHARDS)
    table = table_frame(docs.sparkSession, names, lookup_table(names, slots, weights))
    hashed = docs.withColumn("slot", F.pmod(F.xxhash64(*key_cols), F.lit(slots)).cast("int")).drop("shard")
    return hashed.join(F.broadcast(table), "slot").select(*[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(placed: DataFrame, path: str, parts: int = 1) -> None:
    """One folder per shard, of ``parts`` files each, so that no task holds a whole large shard."""
    shards = placed.select("shard").distinct().count()
    spread = placed.withColumn("_part", F.pmod(F.xxhash64(*placed.columns), F.lit(parts)))
    spread.repartition(max(1, shards * parts), "shard", "_part").drop("_part").write.partitionBy("shard").parquet(path)
