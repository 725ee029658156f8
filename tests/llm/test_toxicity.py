"""The string kernel by definition, tolerance of inserted characters, held-out accuracy."""

from itertools import combinations

import numpy as np
import pytest

from subtide.llm import toxicity


def bag(unit):
    unit, found = "\x02" + unit + "\x03", {}
    for i, j, k in combinations(range(len(unit)), 3):
        if k - i < 5:
            key = unit[i] + unit[j] + unit[k]
            found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i + 1)
    norm = sum(v * v for v in found.values()) ** 0.5
    return {k: v / norm for k, v in found.items()}


def test_bags_follow_the_definition():
    units = ["idiot", "i.d.i.o.t", "aaaa", "ñandú", "x", "abcabcabc"]
    row, feature, weight = toxicity.bags(units)
    for i, unit in enumerate(units):
        mine = {chr(f >> 42) + chr((f >> 21) & 0x1FFFFF) + chr(f & 0x1FFFFF): w for r, f, w in zip(row.tolist(), feature.tolist(), weight.tolist()) if r == i}
        expected = bag(unit)
        assert mine.keys() == expected.keys() and all(abs(mine[k] - expected[k]) < 1e-9 for k in mine)


def test_units():
    assert toxicity.units_of('"Scum!,') == ["Scum"]
    assert toxicity.units_of("st-up1d") == ["st-up1d", "stupd"]
    assert toxicity.units_of("...") == []
    long = "".join(chr(97 + i % 26) for i in range(100))
    assert all(len(u) <= toxicity.UNIT_CHARS for u in toxicity.units_of(long))
    assert {long[i: i + 5] for i in range(96)} == {u[i: i + 5] for u in toxicity.units_of(long) for i in range(len(u) - 4)}


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.train(docs, labels)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    rows = toxicity.score(docs, model).filter("held_out").join(labels, "doc_id").select("predicted", "toxic", "score").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 for r in rows)


def test_gapped_insults_count(trained):
    scorer = toxicity.Scorer(trained[2])
    plain = "The quick brown fox jumps over it."
    texts = [plain, "You i.d.i.o.t of it.", "you s t u p i d it", "a path-etic thing", "STUPID", "", None, " \n"]
    clean, *insults, empty, null, blank = scorer.documents(texts)
    assert min(insults) > clean
    assert empty == null == blank == toxicity.NOTHING


def test_odd_rows_and_missing_labels(spark, odd, none, trained):
    model = trained[2]
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, model).collect() == []
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    labels = spark.createDataFrame([(1, 1, "x"), (None, 1, "x"), (2, None, "x")], "doc_id long, toxic int, text string")
    assert toxicity.train(odd, labels) is None and toxicity.train(none, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}


def test_machine_separates():
    bad, good = ["moron", "scumbag", "idiot", "worthless"], ["morning", "scuba", "idea", "worth", "house", "garden", "window", "paper"]
    model = toxicity._train_units(bad, np.ones(4), good, 12)
    assert model.margins(bad).min() > 0 > model.margins(good).max()
