"""Token counts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of a batch lie one after another in flat numpy arrays. In each round every
sequence applies its own lowest-rank pair, at all places at once; a sequence without a pair is
finished and its symbols are counted.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.wordpieces import byte_symbols, piece_finder, plain_patterns, split_added

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pre-tokens remembered per Python worker, and pre-tokens merged at once.
REMEMBERED, AT_ONCE = 300_000, 20_000
#: Where a byte-level vocabulary cuts texts (fixed by its kind).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|[\s]+(?![^\s])|[\s]+"""
NO_RANK = np.iinfo(np.int64).max


def definition_of(path: str) -> dict:
    """What counting needs of a tokenizer file: added tokens, the pattern made plain, and arrays.

    The arrays are the id of each byte, sorted pair keys, and their ranks and merged ids.
    """
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    ids = read["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
    keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], dtype=np.int64)
    made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    return {
        "added": [a["content"] for a in read["added_tokens"]],
        "patterns": plain_patterns(PATTERN),
        "bytes": np.array([ids[s] for s in byte_symbols()], dtype=np.int64),
        "keys": keys[order],
        "ranks": order.astype(np.int64),
        "made": made[order],
    }


def count_symbols(sequences: list[bytes], table: dict[str, np.ndarray]) -> np.ndarray:
    """Symbols that survive all merges, for each sequence of bytes (none empty)."""
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    counts = lengths.copy()
    symbols = table["bytes"][np.frombuffer(b"".join(sequences), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(sequences)), lengths)
    while len(symbols) > 1:
        # Rank of each symbol with the next one of the same sequence.
        same = owner[:-1] == owner[1:]
        keys = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(table["keys"], keys), len(table["keys"]) - 1)
        known = same & (table["keys"][at] == keys)
        if not known.any():
            break
        rank = np.append(np.where(known, table["ranks"][at], NO_RANK), NO_RANK)
        starts = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbols)))
        chosen = (rank == np.repeat(least, sizes)) & (rank != NO_RANK)
        # In a run such as "aaa" pairs overlap: every second one counts, from the left.
        where = np.flatnonzero(chosen)
        first = np.append(True, np.diff(where) != 1)
        place = np.arange(len(where)) - np.maximum.accumulate(np.where(first, np.arange(len(where)), 0))
        where = where[place % 2 == 0]
        symbols[where] = table["made"][at[where]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[where + 1] = False
        counts -= np.bincount(owner[where], minlength=len(counts))
        # Finished sequences leave the arrays.
        keep &= np.repeat(least != NO_RANK, sizes)
        symbols, owner = symbols[keep], owner[keep]
    return counts


class Counter:
    """Counts tokens of whole texts, remembering pre-tokens."""

    def __init__(self, definition: dict):
        self.table, self.cut = definition, split_added(definition["added"])
        self.pieces = piece_finder(definition["patterns"])
        self.known: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        for i in range(0, len(new), AT_ONCE):
            some = new[i : i + AT_ONCE]
            self.known.update(zip(some, count_symbols([s.encode() for s in some], self.table).tolist()))

    def counts(self, texts: list[str], together: int = 64) -> list[int]:
        """Counts of many texts; what several texts bring anew is merged in one go."""
        out: list[int] = []
        for i in range(0, len(texts), together):
            cut = [[self.pieces(s) if not k % 2 else s for k, s in enumerate(self.cut(t))] for t in texts[i : i + together]]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            missing = {p for c in cut for s in c[::2] for p in s if p not in self.known}
            if missing:
                self.learn(list(missing))
            known = self.known.__getitem__
            out += [sum(sum(map(known, s)) for s in c[::2]) + len(c[1::2]) for c in cut]
        return out


def token_counts(docs: DataFrame, definition: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row of ``docs``.

    Counts are those of the tokenizer file's own library without begin or end tokens; an added
    token in a text is one token. Null text is empty: 0 and 0. Texts are counted whole; repeated
    rows each get a row, other columns are ignored. ``definition`` comes from
    ``definition_of`` on the driver and is broadcast (2 MB).
    """
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shipped.value)
        for batch in batches:
            texts = batch.pop("_text").tolist()
            yield batch.assign(n_tokens=np.array(counter.counts(texts), dtype="int64"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    picked = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    kind = picked.schema[id_col].dataType.simpleString()
    return picked.mapInPandas(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
