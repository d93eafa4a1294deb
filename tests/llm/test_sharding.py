import numpy as np
import pytest

from gearwatch.llm import sharding
from tests.llm.odd import ROWS, odd_documents


def by_the_book(names, slots):
    """Each shard's whole permutation first, then turns."""
    import hashlib

    orders = []
    for name in names:
        h = hashlib.sha256(name.encode()).digest()
        offset, skip = int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:16], "big") % (slots - 1) + 1
        orders.append([(offset + j * skip) % slots for j in range(slots)])
    owner, turn = [None] * slots, 0
    while None in owner:
        shard = turn % len(names)
        free = next(s for s in orders[shard] if owner[s] is None)
        owner[free] = shard
        turn += 1
    return owner


def test_table_is_filled_by_turns():
    names = sharding.shard_names(7)
    assert sharding.lookup_table(names, 251).tolist() == by_the_book(names, 251)


def test_shares_differ_by_one_slot_and_follow_weights():
    counts = np.bincount(sharding.lookup_table(sharding.shard_names(100)))
    assert counts.max() - counts.min() <= 1
    heavy = np.bincount(sharding.lookup_table(["a", "b"], 10_007, [1, 3]))
    assert abs(heavy[1] - 3 * heavy[0]) <= 4


def test_few_slots_move_when_a_shard_goes():
    names = sharding.shard_names(50)
    before = sharding.lookup_table(names)
    after = sharding.lookup_table(names[:-1])
    stayed = before != 49
    assert (before[stayed] != after[stayed]).mean() < 0.1


@pytest.mark.parametrize("names, slots, weights", [([], 7, None), (["a", "a"], 7, None), (["a"], 8, None), (["a"], 7, [0]), (["a", "b", "c"], 2, None)])
def test_bad_tables_are_refused(names, slots, weights):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, slots, weights)


def test_odd_rows_are_placed(spark):
    placed = sharding.place(odd_documents(spark)).select("doc_id", "slot", "shard").collect()
    assert len(placed) == len(ROWS)
    assert all(r.shard for r in placed)
    assert len({r.shard for r in placed if r.doc_id == 1}) == 1
    assert sharding.place(odd_documents(spark, [])).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    placed = sharding.place(spark.range(500).withColumnRenamed("id", "doc_id"), names=["a", "b", "c"], slots=101)
    sharding.write_shards(placed, str(tmp_path / "shards"), parts=2)
    again = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in again.collect()) == list(range(500))
    assert {tuple(r) for r in again.select("doc_id", "shard").collect()} == {tuple(r) for r in placed.select("doc_id", "shard").collect()}
