import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gearwatch.llm import merging, wordpieces
from tests.llm.odd import ROWS, odd_documents

PIECES = list(" \t\n\r\x0b\x0c\x1c\x85\xa0 　​﻿abBzZéÉßİıΣσς'’sStT0123٣½²一😀́­<|>_-#$%Ωﬁ\x00\x7f") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'re", "hello", "aaaa", "é", "ΑΣ ", "internationalisation",
]


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(4)
    return ["".join(chance.choices(PIECES, k=chance.randint(0, 30))) for _ in range(3000)] + ["a" * 3000, " \n" * 90, "ha" * 700]


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_counts_match_the_library(texts):
    definition = merging.definition_of(public_tokenizers.path("byte_bpe_50k.json"))
    counter = merging.Counter(definition)
    want = [len(e.ids) for e in library("byte_bpe_50k.json").encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts) == want


def test_forgetting_changes_nothing(texts, monkeypatch):
    definition = merging.definition_of(public_tokenizers.path("byte_bpe_50k.json"))
    want = merging.Counter(definition).counts(texts[:300])
    monkeypatch.setattr(merging, "REMEMBERED", 10)
    monkeypatch.setattr(merging, "AT_ONCE", 3)
    assert merging.Counter(definition).counts(texts[:300], together=7) == want


def test_encoding_and_decoding_match_the_library(texts):
    bpe, tokenizer = wordpieces.WordBpe(wordpieces.definition_of(public_tokenizers.path("word_bpe_49k.json"))), library("word_bpe_49k.json")
    for text in texts:
        ids, shown = bpe.encode(text)
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert shown == bpe.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


def test_long_words_match_the_library_and_end(monkeypatch):
    definition = wordpieces.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    chance, tokenizer = random.Random(9), library("word_bpe_49k.json")
    for size in (255, 256, 257, 300, 3000, 20_000):
        word = "".join(chance.choices("etaoinshrdlu", k=size))
        for text in (word, "ab" * (size // 2), "a" * size):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(wordpieces.WordBpe(definition).encode(text)[0], "<u4").tolist() == want
    word = "".join(chance.choices("etaoinshrdlu", k=1_000_000))
    started = time.time()
    long = wordpieces.WordBpe(definition).parts(word)
    assert time.time() - started < 60 and "".join(long) == word + "</w>"
    # Scanning and the heap agree.
    monkeypatch.setattr(wordpieces, "LONG", 10**9)
    assert wordpieces.WordBpe(definition).parts(word[:3000]) == wordpieces.WordBpe(definition)._long_parts(word[:3000] + "</w>", 3000)


def test_a_long_word_is_counted_in_time():
    definition = merging.definition_of(public_tokenizers.path("byte_bpe_50k.json"))
    word = "".join(random.Random(5).choices("etaoinshrdlu", k=50_000))
    started = time.time()
    got = merging.Counter(definition).counts([word])
    assert time.time() - started < 60
    assert got == [len(library("byte_bpe_50k.json").encode(word, add_special_tokens=False).ids)]


def test_decoded_text_shows_a_fault_in_the_ids(spark, monkeypatch):
    definition = wordpieces.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    word = wordpieces.WordBpe._word

    def faulty(self, piece):
        made = word(self, piece)
        wrong = self.ids["a</w>"].to_bytes(4, "little")
        return (wrong, *made[1:]) if isinstance(made, tuple) else wrong

    monkeypatch.setattr(wordpieces.WordBpe, "_word", faulty)
    assert wordpieces.WordBpe(definition).encode("hello <|endoftext|>")[1] == "a</w> <|endoftext|>"
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    assert wordpieces.encoded(docs, definition, digest=False).first().decoded == "a</w> a</w>"


def test_odd_documents(spark):
    counted = merging.token_counts(odd_documents(spark), merging.definition_of(public_tokenizers.path("byte_bpe_50k.json"))).collect()
    tokenizer = library("byte_bpe_50k.json")
    want = sorted((i or 0, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in ROWS)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counted) == want

    definition = wordpieces.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = library("word_bpe_49k.json")
    want = []
    for i, t, _, _ in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    got = wordpieces.encoded(odd_documents(spark), definition, keep=("row",), digest=False).collect()
    assert sorted((r.doc_id or 0, list(r.ids), r.decoded) for r in got) == sorted(want)
    digests = wordpieces.encoded(odd_documents(spark), definition).collect()
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in digests) == sorted(
        (i, hexed(np.array(ids, "<u4").tobytes()), hexed(s.encode())) for i, ids, s in want
    )


def test_empty_tables(spark):
    empty = odd_documents(spark, [])
    assert merging.token_counts(empty, merging.definition_of(public_tokenizers.path("byte_bpe_50k.json"))).count() == 0
    assert wordpieces.encoded(empty, wordpieces.definition_of(public_tokenizers.path("word_bpe_49k.json"))).count() == 0
