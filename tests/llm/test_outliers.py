from collections import Counter

import numpy as np
import pytest

from gearwatch.llm import outliers
from tests.llm.odd import LONG, ROWS, WORDS, odd_documents


def plain_statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_match_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(900 + i, t, "en", "s") for i, t in enumerate([
        "a b c d e a b c d e", "x\n\nx\n y\nx", "a " * 30, LONG, "\n".join(["same line of words here"] * 9), None, "",
    ])]
    docs = docs.select("doc_id", "text", "lang", "source").unionByName(odd_documents(spark, extra).select("doc_id", "text", "lang", "source"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in outliers.quality_verdicts(docs).collect():
        want = plain_statistics(texts[row.doc_id])
        assert tuple(row[c] for c in STATS) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (row.base_failed and row.kept)


def test_odd_documents_and_empty_table(spark):
    got = outliers.quality_verdicts(odd_documents(spark)).collect()
    assert len(got) == len(ROWS)
    assert {r.kept for r in got if r.doc_id in (2, 3, 4, 8, 9)} == {False}
    assert {r.kept for r in got if r.doc_id in (1, None)} == {True}  # too few rows for any estimate
    assert outliers.quality_verdicts(odd_documents(spark, [])).count() == 0


def test_planted_outliers_go_and_the_rest_stays(spark):
    random = np.random.default_rng(3)
    text = lambda n, size: " ".join("".join(random.choice(list("abcdefgh"), max(1, int(random.normal(size, 1))))) for _ in range(n))
    rows = [(i, text(int(random.integers(30, 200)), 5), "en", "s" if i % 3 else "t") for i in range(400)]
    rows += [(1000 + i, text(60, 5).replace(" ", " | "), "en", "s") for i in range(40)]
    rows += [(2000 + i, text(60, 14), "en", "t") for i in range(10)]
    rows += [(3000 + i, text(60, 5), None, None) for i in range(5)]
    got = {r.doc_id: r.kept for r in outliers.quality_verdicts(odd_documents(spark, rows)).collect()}
    assert all(got[i] for i in range(400)) and all(got[3000 + i] for i in range(5))
    assert not any(got[1000 + i] for i in range(40)) and not any(got[2000 + i] for i in range(10))


def test_constants():
    assert outliers.chi_square_4(0.05) == pytest.approx(9.4877, abs=1e-4)
    assert outliers.consistency(0.999999) == pytest.approx(1, abs=1e-3)
