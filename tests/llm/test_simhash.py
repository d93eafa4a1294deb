import numpy as np
import xxhash

from gearwatch.llm import simhash
from gearwatch.llm.components import connected_components
from tests.llm.odd import ROWS, WORDS, groups_of, lower_az, odd_documents


def plain_fingerprint(text):
    words = WORDS.findall(lower_az(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    bits = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles)
        bits |= (2 * ones > len(shingles)) << bit
    return bits


def crowd(seed, balls=6, size=150, flips=6, loners=600):
    """Dense balls of fingerprints among lonely ones."""
    random = np.random.default_rng(seed)
    prints = [random.integers(0, 2**64, loners, dtype=np.uint64)]
    for _ in range(balls):
        centre = random.integers(0, 2**64, dtype=np.uint64)
        for _ in range(size):
            flipped = centre
            for bit in random.integers(0, 64, random.integers(0, flips)):
                flipped ^= np.uint64(1) << np.uint64(bit)
            prints.append(np.array([flipped], dtype=np.uint64))
    return np.unique(np.concatenate(prints))


def test_fingerprints_match_plain_python():
    texts = [r[1] for r in ROWS if r[0] != 5]
    got = simhash.simhashes([(t or "").encode() for t in texts], block=7)
    assert [int(x) for x in got] == [plain_fingerprint(t) for t in texts]


def test_links_of_dense_and_lonely_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_SIZE", 64)
    monkeypatch.setattr(simhash, "LEAF", 16)
    for seed, parts in ((1, 2), (2, 1), (3, 4)):
        prints = crowd(seed)
        nodes = spark.createDataFrame([(int(p), i) for i, p in enumerate(prints.view(np.int64).tolist())], "fingerprint long, node long")
        nodes = nodes.selectExpr("fingerprint", "node")
        links = simhash.close_links(nodes, parts=parts)
        found = links.collect()
        assert all(np.bitwise_count(prints[a] ^ prints[b]) <= 64 for a, b in found)
        roots = dict(tuple(r) for r in connected_components(links, "a", "b").collect())
        want = groups_of(range(len(prints)), lambda i, j: np.bitwise_count(prints[i] ^ prints[j]) <= 3)
        assert [roots.get(i, i) for i in range(len(prints))] == want
        assert len(found) < 30 * len(prints)


def test_odd_documents(spark):
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd_documents(spark)).collect())
    prints = {i or 0: plain_fingerprint(t) for i, t, _, _ in ROWS}
    assert [(i, f & 2**64 - 1) for i, f, _ in got] == sorted((i or 0, plain_fingerprint(t)) for i, t, _, _ in ROWS)
    named = [i for i in prints if i]
    want = dict(zip(named, groups_of(named, lambda a, b: (prints[named[a]] ^ prints[named[b]]).bit_count() <= 3)))
    assert {i: c for i, _, c in got if i} == want
    assert want[3] == want[4] == 2 and want[9] == 8
    assert [c for i, _, c in got if not i] == [None]


def test_empty_table(spark):
    assert simhash.near_duplicates(odd_documents(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (None, 4)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(1, 61)} | {i: 1000 for i in range(1001, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
