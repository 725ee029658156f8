"""Recall against brute force, exact scores and order, odd vectors."""

import numpy as np
import pytest

from subtide.llm import collision_ann as ann


def brute(ids, vectors, query_id, k):
    own = ids.index(query_id)
    scores = vectors @ vectors[own]
    order = sorted((i for i in range(len(ids)) if i != own), key=lambda i: (-scores[i], ids[i]))
    return [(ids[i], scores[i]) for i in order[:k]]


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_order(spark, monkeypatch, scale):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [r.vec_id for r in rows]
    vectors = np.array([r.embedding for r in rows], dtype=np.float64)
    if scale:  # inner products of vectors of many lengths
        vectors *= np.random.default_rng(1).uniform(0.2, 3, len(ids))[:, None]
    table = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, score string")
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    found = ann.nearest(table, table.filter("vec_id % 20 = 0")).collect()
    hits = total = 0
    for query in sorted(i for i in ids if i % 20 == 0):
        mine = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        exact = dict(brute(ids, vectors, query, 20))
        for r in mine:
            assert r.score == pytest.approx(float(vectors[ids.index(query)] @ vectors[ids.index(r.vec_id)]), abs=1e-12)
        hits, total = hits + sum(r.vec_id in exact for r in mine), total + 20
    assert hits / total >= 0.95


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.5]),
        (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (60, [1.0, 2.0, 3.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS dims", "2 AS block", "3 AS rank")
    found = [tuple(r) for r in ann.nearest(table, table.filter("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 3, 1.0)]
    assert ann.nearest(table.limit(0), table.limit(0)).collect() == []


def test_windows_count_what_lies_outside():
    rng = np.random.default_rng(2)
    block = ann.Block(np.arange(500), rng.standard_normal((500, 8)))
    at = ann.lines(8) @ rng.standard_normal(9)
    places = np.empty((ann.LINES, 500))
    np.put_along_axis(places, block.order.astype(np.int64), block.places, axis=1)
    for radius in (0.1, 0.7, 3.0):
        inside = (places >= (at - ann.REACH * radius)[:, None]) & (places < (at + ann.REACH * radius)[:, None])
        assert (block.misses(at, radius) == (~inside).sum(axis=0)).all()


def test_many_copies_of_one_vector(spark):
    """A thousand copies near the queries: the least ids of them are found, by rank."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 16))
    ids = list(range(1500))
    copied = rng.permutation(1500)[:1000]
    vectors[copied] = vectors[copied[0]]
    vectors[3] = -0.0 * vectors[3]  # a zero vector, of either sign
    near = np.concatenate([vectors[copied[:1]] + 0.05 * rng.standard_normal((40, 16)), rng.standard_normal((20, 16))])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    asked = [(5000 + i, v.tolist()) for i, v in enumerate(near)] + [(int(i), vectors[i].tolist()) for i in copied[:10]]
    found = {}
    for r in ann.nearest(table, spark.createDataFrame(asked, "vec_id long, embedding array<double>")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    hits = 0
    for query_id, v in asked:
        scores = vectors @ np.array(v)
        order = [i for i in sorted(ids, key=lambda i: (-scores[i], i)) if i != query_id and vectors[i].any()][:20]
        mine = [i for _, i in sorted(found[query_id])]
        assert len(mine) == 20
        hits += len(set(mine) & set(order))
        if vectors[order[-1]].tolist() == vectors[copied[0]].tolist() == vectors[order[0]].tolist():
            assert mine == order
    assert hits / (20 * len(asked)) > 0.98
