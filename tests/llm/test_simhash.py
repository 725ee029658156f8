"""Fingerprints and components against brute force, with crowded keys and dense groups."""

import random

import numpy as np
import pytest
import xxhash

from subtide.llm import simhash
from subtide.llm.components import connected_components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(runs))


def components(fps, radius=4):
    """The least fingerprint each one reaches."""
    fps = sorted(set(fps))
    root = {}
    for start in fps:
        if start not in root:
            todo = [start]
            while todo:
                x = todo.pop()
                root[x] = start
                todo += [y for y in fps if y not in root and (x ^ y).bit_count() <= radius]
    return root


def test_close_fingerprints_agree_under_a_mask():
    rng = random.Random(1)
    masks = [m % 2**64 for m in simhash.block_masks()]
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_majority_over_many_hashes():
    rng = np.random.default_rng(4)
    sizes = np.array([0, 1, 2, 70_000, 0, 3])
    hashes = rng.integers(0, 2**64, sizes.sum(), dtype=np.uint64)
    found = simhash.majority_bits(hashes, sizes)
    for fp, part in zip(found.tolist(), np.split(hashes, np.cumsum(sizes)[:-1])):
        assert fp == sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > len(part))


def check(docs):
    rows = docs.collect()
    root = components([fingerprint(r.text) for r in rows])
    least = {}
    for r in rows:
        key = root[fingerprint(r.text)]
        if r.doc_id is not None:
            least[key] = min(least.get(key, r.doc_id), r.doc_id)
    expected = [(r.doc_id, fingerprint(r.text), least.get(root[fingerprint(r.text)])) for r in rows]
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(root[fingerprint(r.text)] for r in kept.collect()) == sorted({root[fingerprint(r.text)] for r in rows})
    for r in kept.collect():
        assert r.doc_id == least.get(root[fingerprint(r.text)])


def test_tables(small, odd, none):
    check(small("documents"))
    check(odd)
    assert simhash.near_duplicates(none).collect() == [] and simhash.deduplicate(none).collect() == []


@pytest.mark.parametrize("key_rows", [8, 4096])
def test_dense_groups_and_crowded_keys(spark, key_rows):
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for center in list(fps)[:3]:
        for _ in range(150):
            x = center
            for bit in rng.sample(range(20), rng.randint(1, 3)):  # they share most blocks
                x ^= 1 << bit
            fps.add(x)
    reps = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = connected_components(simhash.near_links(reps, key_rows=key_rows)).collect()
    groups = {}
    for r in roots:
        groups.setdefault(r.root, set()).add(r.node % 2**64)
    expected = {}
    for fp, root in components(fps).items():
        expected.setdefault(root, set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(5, 5), (7, 6)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1040), 1000)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
