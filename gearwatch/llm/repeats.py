"""Substring dedup with prefix-partitioned suffix trees.

A passage of at least ``WINDOW`` words that also starts in a document with a smaller id goes.

*Suffixes.* A window is the start of a suffix. Only suffixes whose beginning can recur matter:
each window has an anchor, the least hash among its runs of ``ANCHOR`` words, which equal windows
share. Anchors are counted first (about one per twenty words); suffixes are cut out for anchors
that occur in two documents or more. Exact copies are settled before, by a digest of their words.

*Groups.* The anchor is the prefix by which suffixes are dealt out; many prefixes make a group
that fits in memory. Equal stretches of text count once, so a crowd of copies does not fill a group.
A prefix with more than ``CROWD`` different stretches is lengthened to the whole window (a digest
of its words), whose groups need no memory: only their smallest document is kept.

*Subtrees.* Within a group, suffixes that share their first 1, 2, 4, ... words hang below one node;
nodes at depth ``WINDOW`` with two documents are the repeats. Runs of them make maximal repeats.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import as_bytes, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, ANCHOR = 50, 10
#: Different stretches a prefix may have before it is lengthened; stretches in a group, on average.
CROWD, GROUP = 4000, 2000
#: Stands for a missing id: larger than any other.
NO_ID = 2**63 - 1
#: Base of the polynomial over bytes, odd so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# --- anchors --------------------------------------------------------------------------------


class Anchors:
    """Anchor of every window of a text."""

    def __init__(self, window: int, run: int):
        self.window, self.run, self.size = window, run, 0

    def _powers(self, size: int) -> None:
        if size > self.size:
            self.size = max(2 * self.size, size, 1 << 16)
            self.up = np.cumprod(np.full(self.size, BASE, dtype=np.uint64))
            self.down = np.cumprod(np.full(self.size, pow(BASE, -1, 2**64), dtype=np.uint64))

    def __call__(self, found: list[bytes]) -> np.ndarray:
        """One hash per window; none if the text is shorter than a window."""
        n = len(found)
        if n < self.window:
            return np.empty(0, dtype=np.uint64)
        joined = b" ".join(found)
        self._powers(len(joined) + 1)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=n)
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        sums = np.concatenate(([np.uint64(0)], np.cumsum(np.frombuffer(joined, dtype=np.uint8) * self.up[: len(joined)])))
        first, last = starts[: n - self.run + 1], ends[self.run - 1 :]
        h = (sums[last] - sums[first]) * self.down[first]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        # Least of the runs inside each window, by doubling.
        width, reach = self.window - self.run + 1, 1
        while 2 * reach <= width:
            h = np.minimum(h[:-reach], h[reach:])
            reach *= 2
        return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if width > reach else h


def anchor_runs(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run with one anchor."""
    first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])) if len(anchors) else np.empty(0, dtype=np.int64)
    return first, np.diff(np.append(first, len(anchors)))


# --- subtrees ---------------------------------------------------------------------------------


def nodes_at_depth(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Node of the suffix tree at ``depth`` that each suffix hangs below, for all start places.

    Suffixes that share 2k symbols share k and, k symbols later, k again. Places closer to the
    end than ``depth`` get what is there; separators are symbols that occur once.
    """
    node, reach = symbols, 1
    while reach < depth:
        step = min(reach, depth - reach)
        ahead = node[np.minimum(np.arange(len(node)) + step, len(node) - 1)]
        node = np.unique(node.astype(np.int64) * (int(node.max()) + 1) + ahead, return_inverse=True)[1]
        reach += step
    return node


def least_documents(stretches: list[list[bytes]], prefix: np.ndarray, doc: np.ndarray, window: int) -> list[np.ndarray]:
    """For each window of each stretch, the least document of all stretches with that window.

    Stretches with different prefixes are never compared.
    """
    lengths = np.array([len(s) for s in stretches], dtype=np.int64)
    every = pd.factorize(np.array([w for s in stretches for w in s], dtype=object))[0]
    starts = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.empty(int(lengths.sum()) + len(stretches), dtype=np.int64)
    word = np.ones(len(symbols), dtype=bool)
    word[starts + lengths] = False
    symbols[word] = every
    symbols[~word] = len(every) + np.arange(len(stretches))  # a separator of its own after each stretch
    node = nodes_at_depth(symbols, window)
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(stretches)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    at = node[starts[owner] + place]
    order = np.lexsort((doc[owner], at, prefix[owner]))
    fresh = np.append(True, (np.diff(at[order]) != 0) | (np.diff(prefix[owner][order]) != 0))
    least = np.empty(len(order), dtype=np.int64)
    least[order] = doc[owner][order][np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    return np.split(least, np.cumsum(counts)[:-1])


def kept_mask(n: int, ranges) -> np.ndarray:
    kept = np.ones(n, dtype=bool)
    for start, stop in ranges:
        kept[start:stop] = False
    return kept


def cut_text(text: bytes, kept: np.ndarray) -> str:
    """The text without the other words; each goes with the space after it."""
    if kept.all():
        return text.decode()
    spans = [m.span() for m in WORD.finditer(text)]
    ends = [s for s, _ in spans[1:]] + [len(text)]
    pieces = [text[s:e] for (s, _), e, k in zip(spans, ends, kept) if k]
    return b"".join(pieces).decode().rstrip(" \t\n\x0b\f\r") if pieces else ""


# --- the operator -------------------------------------------------------------------------------


def _tokenised(docs: DataFrame, window: int, run: int) -> DataFrame:
    """Rows with n_words, digest, payload, anchors for their text: one scan, packed for the shuffles."""

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, pack = Anchors(window, run), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                split = [t.split() for t in part["text"]]
                yield part.drop(columns="text").assign(
                    n_words=np.array([len(w) for w in split], dtype="int64"),
                    digest=[hashlib.sha256(b" ".join(w)).digest() for w in split],
                    payload=[pack.compress(t) for t in part["text"]],
                    anchors=[np.unique(hashed(w)).view(np.int64) for w in split],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInPandas(tokenise, f"{fields}, n_words long, digest binary, payload binary, anchors array<long>")


def _stretches(texts: DataFrame, window: int, run: int) -> DataFrame:
    """Stretches of text around shared anchors, each with a digest of its words."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, unpack = Anchors(window, run), zstandard.ZstdDecompressor()
        columns = ["prefix", "whole", "row", "doc", "start", "words"]
        for batch in batches:
            out = []
            for row, doc, payload, shared in zip(*(batch[c] for c in ("row", "doc", "payload", "shared"))):
                found = unpack.decompress(payload).split()
                anchors = hashed(found).view(np.int64)
                first, count = anchor_runs(anchors)
                wanted = np.isin(anchors[first], shared)
                for a, n in zip(first[wanted].tolist(), count[wanted].tolist()):
                    words = b" ".join(found[a : a + n + window - 1])
                    out.append((int(anchors[a]), digest_of(words), row, doc, a, words))
                if len(out) > 2000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    return texts.mapInPandas(cut, "prefix long, whole binary, row long, doc long, start int, words binary")


def _windows(kinds: DataFrame, window: int) -> DataFrame:
    """Digests of the windows of stretches whose prefix is too common."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            split = [w.split() for w in batch.pop("words")]
            yield batch.assign(
                digests=[[digest_of(b" ".join(w[i : i + window])) for i in range(len(w) - window + 1)] for w in split]
            )

    named = kinds.select("prefix", "whole", "low", "words")
    return named.mapInPandas(digest, "prefix long, whole binary, low long, digests array<binary>")


def digest_of(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def repeat_ranges(packed: DataFrame, window: int = WINDOW, run: int = ANCHOR) -> DataFrame:
    """(row, ranges): for rows with repeats, ranges of words that windows of smaller documents cover.

    ``packed`` is a stored table of ``_tokenised`` rows.
    """
    spark = packed.sparkSession
    long_ones = packed.where(F.col("n_words") >= window).select("row", "doc", "digest", "n_words")
    copies, _ = stored(long_ones.groupBy("digest").agg(F.min("doc").alias("first_doc")), "copies")
    # Copies with a larger id go whole; the others stand for all.
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
    settled = long_ones.join(copies, "digest").where("doc > first_doc").select("row", whole.alias("ranges"))
    active = packed.where(F.col("n_words") >= window).select("row", "doc", "digest", "anchors").join(copies, "digest")
    active = active.where("doc = first_doc").select("row", "doc", F.explode("anchors").alias("prefix"))
    counted = active.groupBy("prefix").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    shared, _ = stored(counted.where("low < high").select("prefix"), "prefixes")
    own = active.join(shared, "prefix").groupBy("row").agg(F.collect_list("prefix").alias("shared"))
    cut, _ = stored(_stretches(packed.select("row", "doc", "payload").join(own, "row"), window, run), "stretches")

    # Equal stretches are looked at once, with their least document: a crowd of copies has few.
    kinds = cut.groupBy("prefix", "whole").agg(F.min("doc").alias("low"), F.first("words").alias("words"))
    kinds, _ = stored(kinds, "kinds")
    sizes = kinds.groupBy("prefix").agg(F.count("*").alias("n"))
    crowded, _ = stored(sizes.where(F.col("n") > CROWD).select("prefix"), "crowded")
    groups = int(max(kinds.count() // GROUP, spark.sparkContext.defaultParallelism, 1))

    def subtrees(group: pd.DataFrame) -> pd.DataFrame:
        split = [w.split() for w in group["words"]]
        least = least_documents(split, group["prefix"].to_numpy(), group["low"].to_numpy(), window)
        return pd.DataFrame({"prefix": group["prefix"], "whole": group["whole"], "least": least})

    rare = kinds.join(crowded, "prefix", "left_anti").withColumn("group", F.pmod(F.xxhash64("prefix"), F.lit(groups)))
    known = rare.groupBy("group").applyInPandas(subtrees, "prefix long, whole binary, least array<long>")
    each = _windows(kinds.join(crowded, "prefix", "left_semi"), window)
    each = each.select("prefix", "whole", "low", F.posexplode("digests").alias("k", "digest"))
    least = each.groupBy("prefix", "digest").agg(F.min("low").alias("least"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "least"))), lambda x: x["least"])
    long_ways = each.join(least, ["prefix", "digest"]).groupBy("prefix", "whole").agg(listed.alias("least"))
    # Each member of a kind loses the windows that a document smaller than its own has.
    members = cut.select("prefix", "whole", "row", "doc", "start").join(known.unionByName(long_ways), ["prefix", "whole"])
    gone = (
        "transform(filter(sequence(0, size(least) - 1), k -> least[k] < doc), "
        f"k -> struct(start + k AS start, start + k + {window} AS stop))"
    )
    ranges = members.select("row", F.expr(gone).alias("ranges")).where(F.size("ranges") > 0)
    merged = ranges.groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return merged.unionByName(settled)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    window: int = WINDOW,
    run: int = ANCHOR,
    texts: bool = True,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text, *keep) per row of ``docs``; no text unless ``texts``.

    A word goes if a window of ``window`` words covers it whose words also start, in a row, in a
    document with a smaller id. Windows are judged on the input. ``kept_text`` keeps the spaces
    of the input, ``kept_sha256`` is the digest of the kept words joined by one space. Null and
    blank texts have no words. Rows with the same id never remove from each other; rows
    without an id count as the largest. Texts shorter than a window stay. Texts are read whole.
    """
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        as_bytes(text_col).alias("text"),
    )
    packed, _ = stored(_tokenised(named, window, run), "packed")
    ranges = repeat_ranges(packed, window, run)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                removed, digests, kept_texts = [], [], []
                for payload, digest, n, found in zip(part["payload"], part["digest"], part["n_words"], part["ranges"]):
                    text = unpack.decompress(payload) if texts or found is not None else b""
                    kept = kept_mask(n, [(r["start"], r["stop"]) for r in found] if found is not None else [])
                    if found is not None:
                        words = [w for w, k in zip(text.split(), kept) if k]
                        digest = hashlib.sha256(b" ".join(words)).digest()
                    removed.append(n - int(kept.sum()))
                    digests.append(digest.hex())
                    kept_texts.append(cut_text(text, kept) if texts else None)
                yield part.drop(columns=["payload", "digest", "ranges"]).assign(
                    n_removed=np.array(removed, dtype="int64"), kept_sha256=digests, kept_text=kept_texts
                )

    carried = ["_id", *[f"_keep_{c}" for c in keep], "n_words"]
    joined = packed.select("row", *carried, "payload", "digest").join(ranges, "row", "left").drop("row")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.select(*carried).schema)
    done = joined.mapInPandas(finish, f"{fields}, n_removed long, kept_sha256 string, kept_text string")
    picked = [F.col("_id").alias(id_col), "n_words", "n_removed", "kept_sha256", *(["kept_text"] if texts else [])]
    return done.select(*picked, *[F.col(f"_keep_{c}").alias(c) for c in keep])
