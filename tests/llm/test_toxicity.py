import zlib

import numpy as np
import pytest

from gearwatch.llm import toxicity
from tests.llm.odd import ROWS, odd_documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()


def test_held_out_accuracy(scored):
    held = [r for r in scored if r.held_out and r.toxic is not None]
    caught = sum(r.predicted and r.toxic for r in held)
    assert caught >= 0.88 * sum(r.toxic for r in held)
    assert caught >= 0.88 * sum(r.predicted for r in held)


def test_scores_and_folds(scored):
    assert len(scored) == 10_000
    for r in scored:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_unseen_misspellings_share_vectors():
    random = np.random.default_rng(5)
    plain = ["".join(random.choice(list("abcdefghijklmnop"), 5)) for _ in range(300)]
    texts, labels = [], []
    for i in range(240):
        words = list(random.choice(plain, 40))
        if i % 4 == 0:
            for at in random.integers(0, 40, 6):
                words[at] = random.choice(["wretchedly", "wretchedness", "scoundrels"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    scorer = toxicity.Scorer(*toxicity.train(texts, np.array(labels)))
    clean = " ".join(plain[:40])
    assert scorer.score(clean) < 0.3
    assert scorer.score(clean + " wretchedd wrettchedly scoundrel scooundrels") > 0.7


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 0), (99, 1), (None, 1), (8, None), (5, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1 and blank.pop() < 0.7
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(odd_documents(spark), none).collect()
    assert len({r.score for r in got}) == 1 and not any(r.predicted for r in got)
    assert toxicity.toxicity(odd_documents(spark, []), none).count() == 0
