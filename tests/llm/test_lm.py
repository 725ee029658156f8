"""Deleted interpolation against plain counting, and its weights."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtide.llm import interpolated_lm as lm


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def check(docs, order, monkeypatch, held=lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2):
    learned = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: learned.append(learn(*a)) or learned[-1])
    found = lm.score(docs, order=order).collect()
    rows = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    counts = [Counter() for _ in range(order + 1)]
    starts = 0
    grams = lambda x, k: [tuple(([None] * k + x)[i + 1: i + 1 + k]) for i in range(len(x))]
    for i, x in rows:
        if not held(i):
            starts += 1
            for k in range(1, order + 1):
                counts[k].update(grams(x, k))
    n, v = sum(counts[1].values()), len(counts[1])
    expected = []
    for i, x in rows:
        p = np.full(len(x), 1 / (v + 1))
        for k in range(1, order + 1):
            for at, gram in enumerate(grams(x, k)):
                context = n if k == 1 else starts if set(gram[:-1]) == {None} and (k == 2 or at == 0) else counts[k - 1][gram[:-1]]
                weight = learned[-1][k - 1][0 if k == 1 else int(context).bit_length()]
                share = counts[k][gram] / context if context else 0
                p[at] = weight * share + (1 - weight) * p[at]
        base = sum(math.log10((counts[1][(t,)] + 1) / (n + v + 1)) for t in x)
        expected.append((str(i), held(i), len(x), sum(counts[1][(t,)] > 0 for t in x), n, base, float(np.log10(p).sum())))
    got = sorted(((str(r.doc_id), *r[1:]) for r in found), key=lambda r: (r[0], r[2], r[5]))
    for a, b in zip(got, sorted(expected, key=lambda r: (r[0], r[2], r[5])), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_counting(small, monkeypatch, order):
    found = check(small("documents"), order, monkeypatch)
    if order == 2:
        held = [r for r in found if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_batches_do_not_matter(small, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_TOKENS", 500)
    monkeypatch.setattr(lm, "RANGE_ENTRIES", 3000)
    check(small("documents"), 2, monkeypatch)


def test_odd_rows(odd, none, monkeypatch):
    check(odd, 2, monkeypatch)
    assert lm.score(none).collect() == []


def test_no_training_documents(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    share = np.array([0.5, 0.0])
    times = np.array([600, 400])  # a share of 0.5 or the uniform 0.01
    weights = lm.learn_weights([share], [np.zeros(2, dtype=np.int64)], times, 0.01)
    likelihood = lambda w: (times * np.log(w * share + (1 - w) * 0.01)).sum()
    assert likelihood(weights[0, 0]) >= max(likelihood(w) for w in rng.random(200)) - 0.1


def test_buckets_without_events_have_the_nearest_weight():
    rng = np.random.default_rng(4)
    buckets = rng.choice([0, 3, 4, 9], 400)
    share = rng.uniform(0, 1, 400) * (buckets > 0)
    level0 = np.full(400, 0.1), np.zeros(400, dtype=np.int64)
    weights = lm.learn_weights([level0[0], share], [level0[1], buckets], np.ones(400, dtype=np.int64), 0.01)
    assert weights[1, 0] == 0
    assert (weights[1, 1:4] == weights[1, 3]).all() and (weights[1, 4:7] == weights[1, 4]).all() and (weights[1, 7:] == weights[1, 9]).all()
    assert len(set(weights[1, [3, 4, 9]])) == 3 and 0.5 not in weights[1, [3, 4, 9]]


def test_a_batch_is_bounded(spark):
    """Each of an executor's Python workers holds one batch at a time in all its arrays."""
    words = " ".join(["a b c d"] * 25_000)
    docs = spark.createDataFrame([(i, words) for i in range(12)], "doc_id long, text string").coalesce(1)
    staged = lm._batches(docs.select("doc_id", F.lit(True).alias("train"), F.lit(False).alias("dev"), "text"), "bigint")
    sizes = [r.tokens for r in staged.collect()]
    assert sum(sizes) == 12 * 100_001 and max(sizes) <= 500_000 + 100_001
