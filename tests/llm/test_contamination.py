import re
import time

from pyspark.sql import functions as F

from gearwatch.llm import contamination
from tests.llm.odd import ROWS, lower_az, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, items, window=13):
    grams = {}
    for item, text in items:
        words = WORD.findall(lower_az(text))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            grams.setdefault(tuple(words[k : k + n]), set()).add(item)
    out = []
    for i, text in docs:
        words, hit, found = WORD.findall(lower_az(text)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(words[k : k + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i or 0, len(words), len(hit), names, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out)


ITEMS = [
    (1, "The quick, brown fox jumps over the lazy dog and runs away from the BIG bad"),
    (2, "one-two"), (10, "one two"), (3, None), (4, "?!"), (None, "istanbul"), (5, "ΣΑΣ İstanbul"), (6, "w5x5 w6x6 w7x0"),
    (7, "a text without an id that is as long as it takes to be called something else"),
]


def got(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination(docs, benchmark, keep=("row",)).collect()
    return sorted((r.doc_id or 0, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found)


def test_odd_documents_and_short_items(spark):
    docs = odd_documents(spark)
    assert got(spark, docs, ITEMS) == plain([r[:2] for r in ROWS], ITEMS)
    assert got(spark, docs, ITEMS[:1]) == plain([r[:2] for r in ROWS], ITEMS[:1])


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", 0)
    assert got(spark, odd_documents(spark), ITEMS) == plain([r[:2] for r in ROWS], ITEMS)


def test_a_long_text_without_broadcast(spark, monkeypatch):
    """Shuffled lines carry the words of one window, so a text of 100,000 words is no trouble."""
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", 0)
    words = [f"w{i % 9973}x{i % 7}" for i in range(100_000)]
    items = [(1, " ".join(words[50_000:50_020])), (2, " ".join(words[99_980:])), (3, "not in there at all, not one word of it in any place")]
    docs = [(1, " ".join(words)), (2, "short"), (3, None)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, row string")
    started = time.time()
    assert got(spark, df, items) == plain(docs, items)
    assert time.time() - started < 120


def test_empty_tables(spark):
    assert got(spark, odd_documents(spark, []), ITEMS) == []
    assert got(spark, odd_documents(spark), []) == plain([r[:2] for r in ROWS], [])
    assert got(spark, odd_documents(spark), [(1, None)]) == plain([r[:2] for r in ROWS], [])


def test_given_tables(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    benchmark = [tuple(r) for r in items.select("item_id", "text").collect()]
    assert got(spark, docs.withColumn("row", F.lit(1)), benchmark) == plain(rows, benchmark)


def test_spans_are_cut(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"], [(1, 2), (2, 2)])], "w array<string>, spans array<struct<start:int,n:int>>")
    assert df.select(contamination.without_spans("w", "spans").alias("t")).first().t == "a e"
