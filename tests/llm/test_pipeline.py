import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gearwatch.llm import outliers
from tests.llm.odd import groups_of, odd_documents
from tests.llm.test_contamination import plain as plain_contamination
from tests.llm.test_repeats import plain as plain_repeats
from tests.llm.test_simhash import plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_quality_keeps_what_the_verdicts_keep(stages):
    kept = [r.doc_id for r in outliers.quality_verdicts(stages[0]).where("kept").collect()]
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in set(kept)]
    assert stages[1].columns == stages[0].columns


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[1])
    prints = [plain_fingerprint(t) for _, t in before]
    want = groups_of([i for i, _ in before], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert rows(stages[2]) == [r for r, g in zip(before, want) if r[0] == g]


def test_repeated_passages_go(stages):
    before = rows(stages[2])
    want = [w[3] for w in plain_repeats(before)]
    after = rows(stages[3])
    assert [i for i, _ in after] == [i for i, _ in before]
    assert [t.encode().split() for _, t in after] == [[x.encode() for x in w] for w in want]
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_contaminated_documents_go(spark, stages, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] or 0 for r in plain_contamination(rows(stages[3]), items) if r[4]}
    assert rows(stages[4]) == [r for r in rows(stages[3]) if r[0] not in bad]


def test_encoded_rows_are_the_results_of_run(spark, stages, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in rows(stages[4]):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in stages[5].select(columns).collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select(columns).collect()) == want


@pytest.mark.parametrize("given", [None, []])
def test_odd_and_empty_tables(spark, sf_dir, given):
    docs = odd_documents(spark, given)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs, _ = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
    got = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    # One of the repeated rows stays; short and blank texts and the one of symbols go.
    assert sorted(r.doc_id or 0 for r in got) == ([] if given == [] else [0, 1, 5, 6])


@pytest.mark.parametrize("step", ["quality", "near_duplicates", "decontamination"])
def test_other_splits_in_a_later_scan_reject_the_same_rows(spark, sf_dir, tmp_path, monkeypatch, step):
    stage = dict(corpus_pipeline.STAGES)[step]
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = rows(stage(spark, docs, sf_dir))
    without = corpus_pipeline._without

    def later(numbered, rejected):
        """The verdicts are written before the other scan is planned."""
        found, _ = corpus_pipeline.stored(rejected, "found")
        spark.conf.set("spark.sql.files.openCostInBytes", "64m")
        return without(numbered, found)

    monkeypatch.setattr(corpus_pipeline, "_without", later)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        got = rows(stage(spark, docs, sf_dir))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert 0 < len(got) < docs.count()
    assert got == want
