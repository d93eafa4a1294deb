"""Documents no operator may stumble over, and plain Python twins."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that clash with names the operators use inside.
CLASHES = "row string, doc string, key string, fingerprint string, node string, words string, n_words string, `_w` string, host string, spans string, d2 string, kept string"
LONG = " ".join(f"w{i % 9973}x{i % 7}" for i in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf.", "en", "s"),
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf.", "en", "s"),
    (2, None, "en", "s"),
    (3, "", None, None),
    (4, " \t\n\x0b\f\r ", "en", None),
    (None, "a text without an id that is as long as it takes to be called a text here", None, "s"),
    (5, LONG, "en", "s"),
    (6, "Ünïcödé wörds ändern nichts, 数据 也 一样 😀 and ΣΑΣ İstanbul", "de", "s"),
    (7, "|" * 200 + " # $ %", "en", "s"),
    (8, "one two", "en", "s"),
    (9, "one two", "en", "s"),
    (10, "<|endoftext|> <|startoftext|>stop<|endoftext|>", "en", "s"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark: SparkSession, rows=None) -> DataFrame:
    clash = tuple("x" for _ in CLASHES.split(","))
    data = [(*r, len(r[1]) if r[1] is not None else None, *clash) for r in (ROWS if rows is None else rows)]
    return spark.createDataFrame(data, f"{SCHEMA}, {CLASHES}")


def lower_az(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def groups_of(ids, linked) -> list:
    """Smallest id reachable for each position, by plain union of all linked pairs."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, own in enumerate(ids):
        r = root(i)
        least[r] = own if r not in least else min(least[r], own)
    return [least[root(i)] for i in range(len(ids))]
