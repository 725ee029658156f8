"""Jump hashing against a plain loop; slots; only the new shard takes rows."""

import zlib

import numpy as np

from subtide.llm.sharding import assign_shards, jump_hash


def plain(key, shards):
    key, here, there = key % 2**64, -1, 0
    while there < shards:
        here = there
        key = (key * 2862933555777941757 + 1) % 2**64
        there = int((here + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return here


def test_jump_hash():
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 3000)
    for shards in (1, 2, 40, 41, 1000):
        found = jump_hash(keys, shards)
        assert found.tolist() == [plain(int(k), shards) for k in keys]
    before, after = jump_hash(keys, 40), jump_hash(keys, 41)
    assert set(after[before != after].tolist()) == {40}


def check(rows, docs):
    assert len(rows) == docs.count()
    for shard in {r.shard for r in rows}:
        mine = [r.slot for r in rows if r.shard == shard]
        assert sorted(mine) == list(range(len(mine)))
    for r in rows:
        assert r.law == "key" and 0 <= r.shard < 40 and (r.grown_shard == r.shard or r.grown_shard == 40)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    key = lambda x: (x[0] is not None, x)
    expected = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=lambda x: str(key(x))) == sorted(expected, key=lambda x: str(key(x)))


def test_tables(small, odd, none):
    for docs in (small("documents"), odd, odd.union(odd)):
        check(assign_shards(docs, 40).collect(), docs)
    assert assign_shards(none, 40).collect() == []


def test_text_keys(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None), ("a", "y")], "doc_id string, text string")
    check(assign_shards(docs, 40).collect(), docs)
