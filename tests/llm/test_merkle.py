import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gearwatch.llm import merkle
from gearwatch.llm.queries import op13_merkle
from tests.llm.odd import ROWS, lower_az, odd_documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entry(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """The last digest and, per node, the (left, right) of each step."""
    paths, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for i in run:
                for leaf in at[i]:
                    paths[leaf].append(("".join(nodes[run.start : i]), "".join(nodes[i + 1 : run.stop])))
        at = [[leaf for i in run for leaf in at[i]] for run in runs]
        nodes = [h(*nodes[run.start : run.stop]) for run in runs]
    return nodes[0], paths


def plain(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = []
    for g in names:
        rows = sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, h(*map(entry, d))))
        made.append((rows, *climb([h(*map(entry, d)) for d in rows])))
    root, above = climb([m[1] for m in made]) if made else ("", [])
    out = []
    for (rows, subroot, paths), upper in zip(made, above):
        for d, own in zip(rows, paths):
            leaf, path = h(*map(entry, d)), own + upper
            cur = leaf
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0:
                cur = h(*map(entry, (*d[:4], None if d[4] is None else lower_az(d[4]))))
            for left, right in path:
                cur = h(left, cur, right)
            out.append((d[0], leaf, subroot, root, h(*[a + b for a, b in path]), cur, cur == root))
    return sorted(out, key=str)


class Table:
    """Stands for a session whose documents are given."""

    def __init__(self, docs):
        self.read, self.parquet = self, lambda path: docs


def found(docs):
    return sorted((tuple(r) for r in op13_merkle(Table(docs), "").collect()), key=str)


def listed(docs):
    return [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("rows", [None, [], ROWS[:1], ROWS[4:5]])
def test_odd_documents(spark, rows):
    docs = odd_documents(spark, rows)
    assert found(docs) == plain(listed(docs))


def test_many_languages(spark):
    docs = spark.createDataFrame([(i, f"T{i}", f"l{i % 70}", None, 2) for i in range(300)] + [(None, None, "", None, None)] * 3,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert found(docs) == plain(listed(docs))


def test_a_language_of_several_blocks(spark):
    """Two rollups, the last block with one leaf."""
    docs = spark.range(2 * 4096 + 1, numPartitions=5).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    docs = docs.unionByName(docs.limit(9).withColumn("lang", F.lit("de")))
    got = found(docs)
    assert got == plain(listed(docs))
    assert 0.6 < sum(r[-1] for r in got) / len(got) < 0.7


def test_a_block_of_a_long_group_stays_small(spark):
    nodes = spark.range(9000).select(F.lit("g").alias("grp"), F.lit(9000).cast("long").alias("n"), F.col("id").alias("rank"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("node"), F.lit(0).alias("below"))
    blocks = merkle.rollup(nodes)
    assert blocks.count() == 3
    opened = merkle.opened(blocks.withColumn("path", F.array().cast(merkle.PATH)))
    assert opened.select(F.max(F.size("path"))).first()[0] == 4 and opened.count() == 9000
