import hashlib

import numpy as np
import pytest

from gearwatch.llm import repeats
from tests.llm.odd import ROWS, odd_documents


def plain(rows, window=50):
    """(n_words, n_removed, digest of what is kept) per row, over all windows in a dictionary."""
    split = [(i if i is not None else 2**63 - 1, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        kept = [True] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                kept[k : k + window] = [False] * window
        left = [w for w, k in zip(words, kept) if k]
        out.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest(), [w.decode() for w in left]))
    return out


def held_against_plain(spark, rows, window=50, run=10):
    docs = odd_documents(spark, [(i, t, "en", "s") for i, t in rows])
    got = repeats.remove_repeats(docs, window=window, run=run).collect()
    mine = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256, r.kept_text.split()) for r in got)
    want = sorted((i is None, i or 0, n, gone, sha, left) for (i, _), (n, gone, sha, left) in zip(rows, plain(rows, window)))
    assert mine == want


@pytest.fixture
def passages():
    random = np.random.default_rng(2)
    vocabulary = [f"v{i}" for i in range(500)]
    text = lambda n: " ".join(random.choice(vocabulary, n))
    shared = [text(n) for n in (50, 51, 49, 120, 300)]
    rows = []
    for i in range(120):
        parts = [text(int(random.integers(0, 80)))]
        for _ in range(random.integers(0, 3)):
            parts += [shared[random.integers(0, len(shared))], text(int(random.integers(0, 30)))]
        rows.append((int(i), "\n".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (2, text(200)), (2, shared[4]), (None, shared[3]), (None, shared[4] + " more")]
    rows += [(600, " ".join(["ha"] * 400)), (601, " ".join(["ha"] * 90)), (602, "  " + shared[3].replace(" ", " \n\t") + "  ")]
    return rows


def test_against_plain_python(spark, passages):
    held_against_plain(spark, passages)


def test_crowded_prefixes(spark, passages, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "GROUP", 5)
    held_against_plain(spark, passages)


def test_short_windows(spark, passages):
    held_against_plain(spark, [(i, (t or "")[:400]) for i, t in passages], window=7, run=3)


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    held_against_plain(spark, rows)


def test_odd_documents_and_empty_table(spark):
    held_against_plain(spark, [r[:2] for r in ROWS])
    assert repeats.remove_repeats(odd_documents(spark, [])).count() == 0


def test_untouched_texts_keep_their_spaces(spark):
    text = "  two  spaces\n\nand lines "
    assert [r.kept_text for r in repeats.remove_repeats(odd_documents(spark, [(1, text, "en", "s")])).collect()] == [text]


def test_nodes_at_any_depth():
    random = np.random.default_rng(1)
    symbols = random.integers(0, 3, 300)
    for depth in (1, 2, 3, 7, 50):
        node = repeats.nodes_at_depth(symbols, depth)
        for i in range(0, 300 - depth, 7):
            for j in range(0, 300 - depth, 5):
                assert (node[i] == node[j]) == (symbols[i : i + depth].tolist() == symbols[j : j + depth].tolist())
