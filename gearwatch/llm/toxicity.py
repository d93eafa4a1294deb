"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax.

A word is the bag of its character n-grams, hashed to buckets; its vector is their average, so a
misspelling nobody saw shares most of its vector with the word that was seen. A text is judged by
its few worst words, whose vectors are averaged under a linear softmax, so a long text does not
drown an insult. Embeddings and softmax are trained jointly in numpy on a bounded sample.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled texts of each class to learn from, at most. The texts are read whole.
TOXIC_TEXTS, CLEAN_TEXTS = 4000, 8000
BUCKETS, DIMS, SIZES = 1 << 16, 12, (3, 4, 5, 6)
#: Worst words that make a passage; passages of a clean text that are learned from.
PASSAGE, NEXT_WORST = 4, 3
#: Texts of the usual mixture that are added to the evidence on each bucket.
DOUBT = 20
EPOCHS, BATCH, RATE, SEED = 10, 64, 0.1, 11
#: Words whose value a Python worker remembers.
REMEMBERED = 200_000
THRESHOLD = 0.7
#: Rows whose checksum leaves this remainder of this divisor are never learned from.
DIVISOR, HELD_OUT = 3, 1

#: Runs of letters and digits with a letter in them; numbers say nothing.
WORD = re.compile(r"[^\W_]*[^\W\d_][^\W_]*")


def held_out(id_col: str) -> Column:
    """True for rows kept for testing; a missing id is not held out, as it has no label either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % DIVISOR == HELD_OUT, F.lit(False))


def grams(word: str) -> list[int]:
    """Buckets of the n-grams of a word with its ends marked."""
    marked = f"<{word}>"
    return [zlib.crc32(marked[i : i + n].encode()) % BUCKETS for n in SIZES for i in range(len(marked) - n + 1)]


def text_words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Sample:
    """Texts as numbers of distinct words, and the buckets of each word, one after another."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.texts = [np.array([numbers.setdefault(w, len(numbers)) for w in text_words(t)], dtype=np.int64) for t in texts]
        sizes, flat = array("q"), array("q")
        for word in numbers:
            bag = grams(word)
            sizes.append(len(bag))
            flat.extend(bag)
        self.sizes, self.flat = np.array(sizes, dtype=np.int64), np.array(flat, dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def rows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words, and for each bucket which of the words it is of."""
        sizes = self.sizes[words]
        owner = np.repeat(np.arange(len(words)), sizes)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[self.starts[words][owner] + within], owner


def worst_words(values: np.ndarray, sets: int = 1) -> np.ndarray:
    """Places of the most toxic words, in sets of ``PASSAGE``: the worst ones, the next ones, ..."""
    wanted = min(len(values), PASSAGE * sets)
    if wanted < len(values):
        worst = np.argpartition(-values, wanted - 1)[:wanted]
    else:
        worst = np.arange(wanted)
    return worst[np.lexsort((worst, -values[worst]))]


def start_values(sample: Sample, labels: np.ndarray) -> np.ndarray:
    """Log-odds of the texts that hold each bucket against those of any text, where training starts.

    ``DOUBT`` texts of the usual mixture are added to each bucket, so that rare ones say little.
    """
    share = labels.mean()
    held = np.array([DOUBT * (1 - share), DOUBT * share])[:, None] * np.ones(BUCKETS)
    for words, label in zip(sample.texts, labels):
        if len(words):
            held[label, np.unique(sample.rows(np.unique(words))[0])] += 1
    return np.log(held[1] / held[0]) - np.log(share / (1 - share))


def worst_passages(sample: Sample, projected: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, label) of the passages each text is judged by: the worst, and for clean texts the next ones too."""
    values = np.add.reduceat(projected[sample.flat], sample.starts) / sample.sizes
    picked, owners = [], []
    for text, label in zip(sample.texts, labels):
        sets = min(len(text) // PASSAGE, 1 if label else NEXT_WORST)
        if sets:
            picked.append(text[worst_words(values[text], sets)].reshape(sets, PASSAGE))
            owners.append(np.full(sets, label))
    return np.concatenate(picked), np.concatenate(owners)


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Value of each bucket and the offset: the difference of the two logits, projected.

    Each epoch finds the worst passages of all texts under the present model; each step then
    moves the embeddings of some of them and the softmax weights down the gradient of the log
    loss (Adagrad). With one class missing there is nothing to learn and all values are 0.
    """
    sample = Sample(texts)
    if not len(sample.flat) or labels.min() == labels.max():
        return np.zeros(BUCKETS), -3.0
    random = np.random.default_rng(SEED)
    weights = random.normal(0, 0.1, (DIMS, 2)) + np.array([-1.0, 1.0]) / np.sqrt(2 * DIMS)
    across = weights[:, 1] - weights[:, 0]
    table = random.normal(0, 0.01, (BUCKETS, DIMS)) + start_values(sample, labels)[:, None] * across / (across @ across)
    offsets = np.array([1.5, -1.5])
    moved_table, moved_weights, moved_offsets = np.full(BUCKETS, 0.1), 0.1, 0.1
    for _ in range(EPOCHS):
        passages, wanted = worst_passages(sample, table @ (weights[:, 1] - weights[:, 0]), labels)
        balance = np.where(wanted == 1, (wanted == 0).sum() / max(1, NEXT_WORST * (wanted == 1).sum()), 1 / NEXT_WORST)
        order = random.permutation(len(wanted))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            across = weights[:, 1] - weights[:, 0]
            words = passages[some].ravel()
            rows, owner = sample.rows(words)
            bags = np.bincount(owner, weights=table[rows] @ across, minlength=len(words)) / sample.sizes[words]
            logits = bags.reshape(-1, PASSAGE).mean(axis=1) + offsets[1] - offsets[0]
            slopes = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - wanted[some]) * balance[some]
            pull = (np.repeat(slopes, PASSAGE) / PASSAGE / sample.sizes[words])[owner]
            towards = pull @ table[rows]
            unique, back = np.unique(rows, return_inverse=True)
            step = np.bincount(back, weights=pull)
            moved_table[unique] += step**2
            table[unique] -= RATE * (step / np.sqrt(moved_table[unique]))[:, None] * across
            moved_weights += float(towards @ towards)
            weights += RATE * np.outer(towards, [1.0, -1.0]) / np.sqrt(moved_weights)
            slope = float(slopes.sum())
            moved_offsets += slope**2
            offsets += RATE * np.array([slope, -slope]) / np.sqrt(moved_offsets)
    return table @ (weights[:, 1] - weights[:, 0]), float(offsets[1] - offsets[0])


class Scorer:
    def __init__(self, values: np.ndarray, offset: float):
        self.values, self.offset = values, offset
        self.word = lru_cache(maxsize=REMEMBERED)(self._word)

    def _word(self, word: str) -> float:
        return float(self.values[grams(word)].mean())

    def score(self, text: str) -> float:
        words = text_words(text)
        values = np.fromiter(map(self.word, words), dtype=float, count=len(words))
        logit = (float(values[worst_words(values)].mean()) if words else 0.0) + self.offset
        return 1 / (1 + float(np.exp(-min(max(logit, -50.0), 50.0))))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[str, int]]:
    """At most ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` labelled texts, chosen by a hash of the id."""
    known = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    one = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    first = [
        one.where(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(most)
        for label, most in ((1, TOXIC_TEXTS), (0, CLEAN_TEXTS))
    ]
    ids = F.broadcast(first[0].unionByName(first[1]))  # a few thousand rows
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = texts.join(ids, "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    return [(r["_text"], r["_label"]) for r in found.orderBy("_id").collect()]


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``; only its text is scored.

    Learned from labelled rows that are not held out, at most ``TOXIC_TEXTS`` and ``CLEAN_TEXTS``
    of them. Null, blank and wordless texts get the score of an average passage of nothing, which
    is low. Without both labels every score is that one. Texts are read whole, repeated rows
    each get a score, labels without a text and other columns are ignored.
    """
    sample = training_texts(docs, labels, id_col, text_col, label_col)
    values, offset = train([t for t, _ in sample], np.array([y for _, y in sample], dtype=np.int64))
    shipped = docs.sparkSession.sparkContext.broadcast((values, offset))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*shipped.value)
        for batch in batches:
            yield batch.assign(score=[scorer.score(t) for t in batch.pop("_text")])

    picked = docs.select(
        F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    kind = picked.schema["_id"].dataType.simpleString()
    scored = picked.mapInPandas(run, f"_id {kind}, held_out boolean, score double")
    return scored.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
